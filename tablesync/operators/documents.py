"""Nested documents: parse, infer per-type schemas, flatten the envelope,
rename / exclude fields, convert dates deeply and null empty structures.

Documents arrive as raw JSON text (one row per document) and are parsed to
``VARIANT``.  Typing is one projection built from a schema inferred by a
distributed ``schema_of_variant_agg`` (only the schema -- one row per
document type -- reaches the driver).  The same projection applies

* the deep date conversion to every string leaf (keys untouched), and
* the empty-structure rule: an object ``{}`` that is the value of a key
  becomes NULL; an ``{}`` that is itself a list item stays; an object whose
  children all become NULL is not itself nulled.

Both rules need the untyped value (``{}`` and ``{"x": null}`` type alike),
which is why they run on the VARIANT while it is being typed.
"""

from __future__ import annotations

import re
import uuid
from collections import OrderedDict

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..functions.names import clean_name
from ..session import case_sensitive, scratch_path
from .metrics import observed

# Envelope keys of a document and the names they take.
ENVELOPE_KEY = "key"
ENVELOPE_ID = "id"
ENVELOPE_FIELDS = "fields"
ENVELOPE_CHANGELOG = "changelog"
KEY_COLUMN = "jira"
TYPE_PATH = '$.fields.issuetype.name'
SUBTASK_PATH = '$.fields.issuetype.subtask'


def parse(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Add ``doc`` (VARIANT) parsed from the JSON text column; text that is no
    JSON document gives NULL instead of failing the batch."""
    return raw.withColumn("doc", F.try_parse_json(F.col(column)))


def _path(name: str) -> str:
    if '"' in name:
        return "$['" + name.replace("'", "\\'") + "']"
    return '$["' + name + '"]'


class _At:
    """A place in a VARIANT column.  Values are read from the column by their whole path and
    in their own type, so no value on the way is built, and a scan reads what is asked for."""

    def __init__(self, base: Column, path: str = "$"):
        self.base, self.path = base, path

    def child(self, name: str) -> _At:
        return _At(self.base, self.path + _path(name)[1:])

    def get(self, dtype: str = "variant") -> Column:
        if dtype == "variant" and self.path == "$":
            return self.base
        return F.try_variant_get(self.base, self.path, dtype)


def key_of(doc: Column | str = "doc") -> Column:
    """The effective document key: ``fields.jira`` where a document holds it
    (dict precedence), else the envelope ``key``."""
    v = F.col(doc) if isinstance(doc, str) else doc
    override = F.try_variant_get(v, f"$.{ENVELOPE_FIELDS}.{KEY_COLUMN}", "variant")
    return F.when(override.isNotNull(), F.try_variant_get(override, "$", "string")).otherwise(
        F.try_variant_get(v, f"$.{ENVELOPE_KEY}", "string")
    )


# --------------------------------------------------------------------------
# schema inference
# --------------------------------------------------------------------------

_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|\bOBJECT<")


def _variant_ddl_to_type(ddl: str | None) -> T.DataType:
    if ddl is None:
        return T.NullType()
    ddl = _OBJECT.sub(lambda m: m.group(1) or "STRUCT<", ddl)
    return T._parse_datatype_string(ddl)


def _normalise(dtype: T.DataType) -> T.DataType:
    """JSON numbers with fractions -> double; VOID -> string."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _normalise(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_normalise(dtype.elementType), True)
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType()
    if isinstance(dtype, T.NullType):
        return T.StringType()
    return dtype


def infer_schemas(docs: DataFrame, by=None) -> dict:
    """Per group: (type of ``fields``, type of ``changelog``), merged over docs.

    A single aggregation job; partial schemas are merged map-side, so a hot
    type costs no more than a cold one.  ``by=None`` gives one group ``""``;
    a column name gives its values as keys; a list of names gives tuples.
    """
    aggs = [
        F.expr(f"schema_of_variant_agg(try_variant_get(doc, '$.{ENVELOPE_FIELDS}', 'variant'))").alias("f"),
        F.expr(f"schema_of_variant_agg(try_variant_get(doc, '$.{ENVELOPE_CHANGELOG}', 'variant'))").alias("c"),
    ]
    grouped = docs.agg(*aggs) if by is None else docs.groupBy(*([by] if isinstance(by, str) else by)).agg(*aggs)
    with case_sensitive(docs.sparkSession):
        found = [tuple(r) for r in grouped.collect()]
    if by is None:
        rows = [("",) + found[0]]
    elif isinstance(by, (list, tuple)):
        rows = [(r[: len(by)],) + r[len(by) :] for r in found]
    else:
        rows = found
    return {
        g: (_normalise(_variant_ddl_to_type(f)), _normalise(_variant_ddl_to_type(c)))
        for g, f, c in rows
    }


def keyed_schema_input(doc: Column, group_key: Column) -> Column:
    """A VARIANT object ``{group_key: {f: fields, c: changelog}}`` per document.

    ``schema_of_variant_agg`` over it merges each group's schema under its
    own key, so one aggregate -- e.g. an Observation attached to the job
    that stages the batch -- yields every group's schema without another
    pass over the data.
    """
    inner = F.struct(
        F.try_variant_get(doc, f"$.{ENVELOPE_FIELDS}", "variant").alias("f"),
        F.try_variant_get(doc, f"$.{ENVELOPE_CHANGELOG}", "variant").alias("c"),
    )
    return F.to_variant_object(F.create_map(group_key, inner))


def split_keyed_schemas(ddl: str | None) -> dict[str, tuple[T.DataType, T.DataType]]:
    """Per group key: (type of ``fields``, type of ``changelog``)."""
    merged = _variant_ddl_to_type(ddl)
    if not isinstance(merged, T.StructType):
        return {}
    out = {}
    for g in merged.fields:
        inner = g.dataType if isinstance(g.dataType, T.StructType) else T.StructType([])
        names = {f.name: f.dataType for f in inner.fields}
        out[g.name] = (_normalise(names.get("f", T.NullType())), _normalise(names.get("c", T.NullType())))
    return out


def staged(raw: DataFrame, column: str = "raw") -> tuple[DataFrame, T.DataType, T.DataType]:
    """(doc VARIANT, type of ``fields``, type of ``changelog``): every document is parsed once."""
    return stage(parse(raw, column))


def stage(parsed: DataFrame) -> tuple[DataFrame, T.DataType, T.DataType]:
    """The column ``doc`` of a frame, computed once, with its merged types.

    The documents are written below the checkpoint folder; the same job merges
    their schema in an Observation, so typing reads binary values instead of parsing the
    text a second time.
    """
    spark = parsed.sparkSession
    watched = Observation(f"documents_{uuid.uuid4().hex[:8]}")
    path = scratch_path(spark, "documents")
    merged = parsed.select("doc").observe(
        watched,
        F.expr(f"schema_of_variant_agg(try_variant_get(doc, '$.{ENVELOPE_FIELDS}', 'variant'))").alias("f"),
        F.expr(f"schema_of_variant_agg(try_variant_get(doc, '$.{ENVELOPE_CHANGELOG}', 'variant'))").alias("c"),
    )
    with case_sensitive(spark):
        merged.write.parquet(path)
    found = observed(watched)
    types = (_normalise(_variant_ddl_to_type(found.get(k))) for k in ("f", "c"))
    return spark.read.schema("doc variant").parquet(path), *types


# --------------------------------------------------------------------------
# typing
# --------------------------------------------------------------------------

def _is_null(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def _by_name(dtype: T.StructType) -> "OrderedDict[str, list[T.StructField]]":
    """Fields grouped by their name in any case: one column each, as Spark and
    most warehouses cannot tell ``Name`` from ``name``."""
    out: OrderedDict[str, list[T.StructField]] = OrderedDict()
    for f in dtype.fields:
        out.setdefault(f.name.lower(), []).append(f)
    return out


def _one_value(values: list[tuple[Column, T.DataType]]) -> Column:
    """The value of a column fed by several keys: per document, the last key
    that holds one; as text where the keys' types differ."""
    if any(d != values[0][1] for _, d in values):
        values = [(F.to_json(c) if isinstance(d, (T.StructType, T.ArrayType)) else c.cast("string"), d) for c, d in values]
    return F.coalesce(*[c for c, _ in reversed(values)]) if len(values) > 1 else values[0][0]


def _needs_walk(dtype: T.DataType, dict_value: bool, null_empty: bool) -> bool:
    """Whether typing this subtree needs the untyped value below its root:
    a struct that is the value of a key (empty-struct rule) or a value of
    mixed shape.  Everything else is cast in one step."""
    if isinstance(dtype, T.VariantType):
        return True
    if isinstance(dtype, T.StructType):
        if (dict_value and null_empty) or not dtype.fields or len(_by_name(dtype)) < len(dtype.fields):
            return True
        return any(_needs_walk(f.dataType, True, null_empty) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _needs_walk(dtype.elementType, False, null_empty)
    return False


def _typed_dates(c: Column, dtype: T.DataType) -> Column:
    """Date rule on an already typed value (structs, arrays)."""
    if isinstance(dtype, T.StringType):
        return times.to_utc_text(c)
    if isinstance(dtype, T.StructType):
        if not any(_has_strings(f.dataType) for f in dtype.fields):
            return c
        inner = F.struct(*[_typed_dates(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(c.isNull(), F.lit(None)).otherwise(inner)
    if isinstance(dtype, T.ArrayType):
        if not _has_strings(dtype.elementType):
            return c
        return F.transform(c, lambda x: _typed_dates(x, dtype.elementType))
    return c


def _has_strings(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StringType):
        return True
    if isinstance(dtype, T.StructType):
        return any(_has_strings(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_strings(dtype.elementType)
    return False


def _walked_json(v: Column, convert_dates: bool, null_empty: bool) -> Column:
    """JSON text of an object or list without a fixed shape, both rules applied at any depth.

    The text of a VARIANT has no white space between its tokens, so it is cut into
    strings and what stands between them: a string before ``:`` is a key, other strings
    follow the date rule, and a ``:{}`` after a key is an empty object that is a key's
    value (one in a list follows no ``:``).  Escaped quotes and backslashes stand aside
    meanwhile as control characters, which JSON text never holds unescaped.
    """
    text = F.replace(F.replace(F.to_json(v), F.lit("\\\\"), F.lit("\u0001")), F.lit('\\"'), F.lit("\u0002"))
    tokens = F.regexp_extract_all(text, F.lit('"[^"]*+"|[^"]++'), F.lit(0))
    following = F.slice(tokens, F.lit(2), F.size(tokens))

    def walked(token: Column, after: Column) -> Column:
        out = F.when(F.lit(False), token)
        if null_empty:
            out = out.when(token.startswith(":{}"), F.concat(F.lit(":null"), F.substr(token, F.lit(4))))
        if convert_dates:
            value = token.startswith('"') & ~F.coalesce(after.startswith(":"), F.lit(False))
            inside = F.substr(token, F.lit(2), F.length(token) - 2)
            out = out.when(value, F.concat(F.lit('"'), times.to_utc_text(inside), F.lit('"')))
        return out.otherwise(token)

    joined = F.array_join(F.zip_with(tokens, following, walked), "")
    return F.replace(F.replace(joined, F.lit("\u0002"), F.lit('\\"')), F.lit("\u0001"), F.lit("\\\\"))


def typed(at: Column | _At, dtype: T.DataType, dict_value: bool = True, convert_dates: bool = True, null_empty: bool = True) -> Column:
    """Typed value of a VARIANT (a column or a place in one) under ``dtype`` (see module doc)."""
    at = at if isinstance(at, _At) else _At(at)
    if isinstance(dtype, (T.StructType, T.ArrayType)) and not _needs_walk(dtype, dict_value, null_empty):
        # one cast for the whole subtree (no rule needs the untyped value)
        cast = at.get(dtype.simpleString())
        return _typed_dates(cast, dtype) if convert_dates else cast
    if isinstance(dtype, T.StructType):
        if not dtype.fields:  # only {} (or nothing) was ever seen here
            text = F.when(_is_null(at.get()), F.lit(None).cast("string")).otherwise(F.to_json(at.get()))
            return F.lit(None).cast("string") if (dict_value and null_empty) else text
        kids = [at.child(f.name) for f in dtype.fields]
        own = {f.name: typed(k, f.dataType, True, convert_dates, null_empty) for k, f in zip(kids, dtype.fields)}
        struct = F.struct(*[_one_value([(own[f.name], f.dataType) for f in fs]).alias(fs[0].name) for fs in _by_name(dtype).values()])
        out = F.when(_is_null(at.get()), F.lit(None))
        if dict_value and null_empty:
            # The schema holds every key seen in any document, so an object
            # is {} exactly when none of its known keys is present.  A key
            # holding JSON null is present (variant null, not SQL NULL).
            # The first key that is there settles it.
            missing = kids[0].get().isNull()
            for k in kids[1:]:
                missing = missing & k.get().isNull()
            out = out.when(missing, F.lit(None))
        return out.otherwise(struct)
    if isinstance(dtype, T.ArrayType):
        arr = at.get("array<variant>")
        return F.transform(arr, lambda x: typed(x, dtype.elementType, False, convert_dates, null_empty))
    if isinstance(dtype, T.StringType):
        s = at.get("string")
        return times.to_utc_text(s) if convert_dates else s
    if isinstance(dtype, T.VariantType):  # conflicting shapes: each value by its own kind
        v = at.get()
        kind = F.schema_of_variant(v)
        text = at.get("string")
        out = F.when(_is_null(v), F.lit(None).cast("string"))
        if dict_value and null_empty:
            out = out.when(kind == "OBJECT<>", F.lit(None).cast("string"))
        out = out.when(kind == "STRING", times.to_utc_text(text) if convert_dates else text)
        out = out.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), _walked_json(v, convert_dates, null_empty))
        return out.otherwise(F.to_json(v))
    return at.get(dtype.simpleString())


def envelope_columns(fields_type: T.DataType, changelog_type: T.DataType, doc: str = "doc", **rules) -> "OrderedDict[str, Column]":
    """Top-level columns of the flattened envelope.

    ``{jira: key, id: id, **fields, changelog: changelog}`` with dict
    semantics, decided per document: where a document's fields hold
    ``jira``/``id``, that value replaces the envelope's (same position);
    ``changelog`` always takes the envelope's value.
    """
    v = F.col(doc)
    cols: OrderedDict[str, Column] = OrderedDict()
    cols[KEY_COLUMN] = F.try_variant_get(v, f"$.{ENVELOPE_KEY}", "string")
    cols[ENVELOPE_ID] = F.try_variant_get(v, f"$.{ENVELOPE_ID}", "string")
    fields = _At(v).child(ENVELOPE_FIELDS)
    if isinstance(fields_type, T.StructType):
        for same in _by_name(fields_type).values():
            f = same[0]
            value = _one_value([(typed(fields.child(s.name), s.dataType, True, **rules), s.dataType) for s in same])
            if f.name in (KEY_COLUMN, ENVELOPE_ID):
                # per document: the field wins only where the document has
                # it (a JSON null counts as present); elsewhere the envelope
                as_text = value if isinstance(f.dataType, (T.StringType, T.VariantType)) else (
                    _walked_json(fields.child(f.name).get(), True, True) if isinstance(f.dataType, (T.StructType, T.ArrayType)) else value.cast("string")
                )
                value = F.when(fields.child(f.name).get().isNotNull(), as_text).otherwise(cols[f.name])
            cols[f.name] = value
    cols[ENVELOPE_CHANGELOG] = typed(_At(v).child(ENVELOPE_CHANGELOG), changelog_type, True, **rules)
    return cols


def rename(cols: "OrderedDict[str, Column]", mapping: dict[str, str] | None, on_collision: str = "last") -> "OrderedDict[str, Column]":
    """Rename by map (unknown names kept), top level only.

    Names are compared case-insensitively, as Spark and most warehouses do.
    Document fields come in sorted key order (VARIANT does not keep the
    JSON text's order), so "last" is deterministic: the later key in sorted
    order wins.
    ``on_collision``: ``last`` (position of the first, value of the last --
    dict semantics), ``suffix`` (``_2``, ``_3`` ...), or ``error``.
    """
    mapping = mapping or {}
    out: OrderedDict[str, Column] = OrderedDict()
    seen: dict[str, str] = {}
    for name, col in cols.items():
        new = mapping.get(name, name)
        low = new.lower()
        if low in seen:
            if on_collision == "error":
                raise ValueError(f"columns collide on {new!r}")
            if on_collision == "suffix":
                i = 2
                while f"{new}_{i}".lower() in seen:
                    i += 1
                new = f"{new}_{i}"
                low = new.lower()
            else:
                out[seen[low]] = col
                continue
        seen[low] = new
        out[new] = col
    return out


def exclude(cols: "OrderedDict[str, Column]", names, protected=(KEY_COLUMN,)) -> "OrderedDict[str, Column]":
    """Drop columns by (renamed) name; the key column is never dropped."""
    drop = {n.lower() for n in (names or [])} - {p.lower() for p in protected}
    return OrderedDict((k, c) for k, c in cols.items() if k.lower() not in drop)


def flatten(
    docs: DataFrame,
    fields_type: T.DataType,
    changelog_type: T.DataType,
    field_map: dict[str, str] | None = None,
    exclude_fields=(),
    protected=(KEY_COLUMN,),
    keep=(),
    on_collision: str = "last",
    convert_dates: bool = True,
    null_empty: bool = True,
) -> DataFrame:
    """Envelope -> typed, renamed, pruned columns (one projection).

    ``keep`` lists extra columns of ``docs`` (e.g. the routing target) kept
    in front.
    """
    cols = envelope_columns(fields_type, changelog_type, convert_dates=convert_dates, null_empty=null_empty)
    cols = rename(cols, field_map, on_collision)
    cols = exclude(cols, exclude_fields, protected)
    return docs.select(*[F.col(k) for k in keep], *[c.alias(n) for n, c in cols.items()])


def field_map_of(fields: DataFrame, id_col: str = "id", name_col: str = "name") -> dict[str, str]:
    """Field-metadata frame (id, display name) -> {id: cleaned name}.

    Metadata of the source's field catalogue: one row per field definition,
    so it is bounded by the source's configuration, not by the data.
    """
    return {r[0]: clean_name(r[1]) for r in fields.select(id_col, name_col).collect()}


def clean_columns(df: DataFrame, on_collision: str = "last") -> DataFrame:
    """Clean every top-level column name of a frame (schema only)."""
    cols = OrderedDict((f.name, F.col(f"`{f.name}`")) for f in df.schema.fields)
    renamed = rename(cols, {n: clean_name(n) for n in cols}, on_collision)
    return df.select(*[c.alias(n) for n, c in renamed.items()])


def deep_to_utc(df: DataFrame, offset: str = times.SOURCE_OFFSET) -> DataFrame:
    """Deep date conversion on an already typed frame (structs, arrays, maps)."""

    def conv(c: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StringType):
            return times.to_utc_text(c, offset)
        if isinstance(dtype, T.StructType):
            inner = F.struct(*[conv(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields])
            return F.when(c.isNull(), F.lit(None)).otherwise(inner)
        if isinstance(dtype, T.ArrayType):
            return F.transform(c, lambda x: conv(x, dtype.elementType))
        if isinstance(dtype, T.MapType):
            return F.transform_values(c, lambda _k, x: conv(x, dtype.valueType))
        return c

    return df.select(*[conv(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
