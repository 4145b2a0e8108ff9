"""Delete-by-key and upsert as anti join + union by name.

The anti join never uses ``NOT IN (subquery)`` (a NULL key would empty the
result); NULL keys on either side delete nothing.  The join strategy is left
to AQE: the changed-key side is broadcast only when its measured runtime size
is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are
shuffled on the key and AQE's skew rule splits a hot key's partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keys_of(changed: DataFrame, key: str = "jira") -> DataFrame:
    """Key projection of the changed rows."""
    return changed.select(F.col(key)).where(F.col(key).isNotNull())


def _distinct_keys(keys: DataFrame, key: str) -> DataFrame:
    # A key repeated in a third of the changed rows is collapsed by the
    # partial aggregate before any shuffle; the result is hash-partitioned on
    # the key, which a sort-merge join reuses without another exchange.
    return keys.select(F.col(key)).distinct()


def delete_by_keys(target: DataFrame, keys: DataFrame, key: str = "jira") -> DataFrame:
    """Rows of ``target`` whose key is not among ``keys``."""
    return target.join(_distinct_keys(keys, key), on=key, how="left_anti")


def deleted_count(target: DataFrame, keys: DataFrame, key: str = "jira") -> DataFrame:
    """One row ``n``: how many target rows a delete by ``keys`` removes."""
    return target.join(_distinct_keys(keys, key), on=key, how="left_semi").agg(F.count(F.lit(1)).alias("n"))


def _as_text(df: DataFrame, names: set[str]) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in names and not isinstance(f.dataType, T.StringType):
            c = F.to_json(c) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Numbers from narrow to wide; an integer and a float meet in a double.
_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FLOATS = [T.FloatType, T.DoubleType]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both; ``None`` where there is none but text."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if type(x) in _INTEGERS and type(y) in _FLOATS or isinstance(x, T.DecimalType) and type(y) in _FLOATS:
            return T.DoubleType()
        if isinstance(x, T.DecimalType) and type(y) in _INTEGERS:
            return common_type(x, T.DecimalType(_DIGITS[type(y)], 0))
        if isinstance(x, T.DateType) and isinstance(y, (T.TimestampType, T.TimestampNTZType)):
            return y
    for order in (_INTEGERS, _FLOATS):
        if type(a) in order and type(b) in order:
            return order[max(order.index(type(a)), order.index(type(b)))]()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = common_type(a.elementType, b.elementType)
        return None if item is None else T.ArrayType(item)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        value = common_type(a.valueType, b.valueType)
        return None if value is None else T.MapType(a.keyType, value)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        mine, theirs = ({f.name.lower(): f for f in x.fields} for x in (a, b))
        fields = []
        for name, f in {**theirs, **mine}.items():
            kind = common_type(mine[name].dataType, theirs[name].dataType) if name in mine and name in theirs else f.dataType
            if kind is None:
                return None
            fields.append(T.StructField(f.name, kind))
        return T.StructType(fields)
    return None


def _plain(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def append_by_name(kept: DataFrame, inserted: DataFrame) -> DataFrame:
    """Insert side: union by name; columns missing on one side become NULL.

    Types meet in :func:`common_type` (int -> bigint -> double), and structs -- also
    inside arrays -- gain the nested fields either side has; a column whose shape
    changed between runs (e.g. text, then a number or an object) is carried as text,
    objects as JSON text, on both sides instead of failing.
    """
    old = {f.name: f.dataType for f in kept.schema.fields}
    new = {f.name: f.dataType for f in inserted.schema.fields}
    shared = {n: common_type(old[n], new[n]) for n in old if n in new and old[n] != new[n]}
    conflicts = {n for n, t in shared.items() if t is None}
    wider = {n: t for n, t in shared.items() if t is not None and _plain(t)}
    frames = []
    for df in (kept, inserted):
        df = _as_text(df, conflicts)
        frames.append(df.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in wider.items() if df.schema[n].dataType != t}) if wider else df)
    return frames[0].unionByName(frames[1], allowMissingColumns=True)


def upsert(target: DataFrame, changed: DataFrame, key: str = "jira") -> DataFrame:
    """Replace the rows of ``target`` whose key occurs in ``changed``."""
    return append_by_name(delete_by_keys(target, keys_of(changed, key), key), changed)


def upsert_all(
    targets: dict[str, DataFrame],
    changed_by_target: dict[str, DataFrame],
    all_changed_keys: DataFrame,
    key: str = "jira",
) -> dict[str, DataFrame]:
    """Upsert over a family of tables (one per document type).

    Every changed key is removed from *every* table -- so a document whose
    type changed leaves its old table -- and each table then receives the
    changed rows routed to it.  Tables that exist only in the batch are
    created; tables absent from the batch only lose keys.
    """
    keys = _distinct_keys(all_changed_keys.where(F.col(key).isNotNull()), key)
    out: dict[str, DataFrame] = {}
    for name, tgt in targets.items():
        kept = delete_by_keys(tgt, keys, key)
        out[name] = append_by_name(kept, changed_by_target[name]) if name in changed_by_target else kept
    for name, rows in changed_by_target.items():
        if name not in out:
            out[name] = rows
    return out


def refresh(target: DataFrame, batch: DataFrame, route: str) -> DataFrame:
    """Full refresh of a routed frame: the batch's tables (values of ``route``) are replaced
    by its rows, the others are kept.  Only the distinct routes of the batch are joined."""
    present = batch.select(route).where(F.col(route).isNotNull()).distinct()
    return append_by_name(target.join(present, route, "left_anti"), batch)


def refresh_all(targets: dict[str, DataFrame], batch_by_target: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Full refresh over a family: tables present in the batch are replaced
    by the batch rows; tables of types absent from the batch are kept."""
    out = dict(targets)
    out.update(batch_by_target)
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    """N-ary union by name (columns missing on a side become NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
