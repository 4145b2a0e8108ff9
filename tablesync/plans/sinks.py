"""Writers: plain table writes with a save mode, and a versioned family of
tables whose new versions become visible together.

Plain writes (``write_table``) cover the three write styles of the source
tool: staged/overwrite, direct with schema evolution (field addition and
relaxation) and direct strict.  For file formats, "field addition" means the
new files may carry extra columns and readers merge schemas; "strict" refuses
an append whose columns differ from the table's.

A :class:`TableFamily` keeps one folder per table (split into key buckets)
and a commit log (``.family/commits``, JSON, compacted into snapshots).  Changes
are written to fresh folders first; one Spark append job then adds the
commit rows for *all* tables at once, so readers see either the old set or
the new set -- never a table deleted but not yet re-filled.  An upsert
rewrites only the buckets its keys fall in; nothing is overwritten in
place, so a version can be built while reading the previous one.  Where a
table format with ``MERGE INTO`` is installed, :func:`merge_family` does
the same work with SQL.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import age_hours, create_file, delete_path, list_dirs


@dataclass(frozen=True)
class Sink:
    """Where tables are written: ``format`` + ``root`` folder (file formats)
    or ``format`` + ``dataset`` (connectors that save by name)."""

    format: str = "parquet"
    root: str | None = None
    dataset: str | None = None
    options: dict = field(default_factory=dict)
    bucket: str | None = None  # connectors: stage the load in this bucket
    versioned: bool = False  # file sinks: overwrite = new version + commit

    def target(self, table: str) -> str:
        if self.root:
            return os.path.join(self.root, table)
        return f"{self.dataset}.{table}" if self.dataset else table


def connector_options(sink: Sink, evolve: bool) -> dict:
    """Options of a connector write: staged in a bucket, or direct -- then with
    field addition and relaxation if the table may evolve.  The sink's own
    options win; file sinks need none of these."""
    if sink.root:
        return dict(sink.options)
    # fixed values: option names of the warehouse connector
    if sink.bucket:
        own = {"temporaryGcsBucket": sink.bucket}
    else:
        own = {"writeMethod": "direct"}
        if evolve:
            own |= {"allowFieldAddition": "true", "allowFieldRelaxation": "true"}
    return own | sink.options


def read_written(spark: SparkSession, sink: Sink, table: str) -> DataFrame:
    """Read a table written by :func:`write_table` (schemas merged)."""
    if sink.versioned:
        df = TableFamily(spark, sink.root, sink.format).read(table)
        if df is None:
            raise FileNotFoundError(f"no committed version of {table}")
        return df
    return spark.read.format(sink.format).option("mergeSchema", "true").load(sink.target(table))


def _existing_schema(spark: SparkSession, sink: Sink, table: str) -> T.StructType | None:
    from ..session import path_exists

    if not path_exists(spark, sink.target(table)):
        return None  # no table yet
    return read_written(spark, sink, table).schema


def write_table(df: DataFrame, sink: Sink, table: str, mode: str = "overwrite", evolve: bool = False) -> None:
    """Write with a save mode (``overwrite``/``append``/``ignore``/``error``).

    ``evolve=False`` on append refuses new or missing columns (strict);
    ``evolve=True`` accepts added columns and relaxes every column to nullable.
    """
    spark = df.sparkSession
    if sink.versioned and sink.root:
        _write_versioned(df, sink, table, mode, evolve)
        return
    if mode == "append" and sink.root:
        existing = _existing_schema(spark, sink, table)
        if existing is not None:
            _check_append(existing, df.schema, table, evolve)
    # Field relaxation needs no step: file sources write every column as
    # nullable, so nothing written is REQUIRED.
    df.write.format(sink.format).options(**connector_options(sink, evolve)).mode(mode).save(sink.target(table))


def _check_append(existing: T.StructType, incoming: T.StructType, table: str, evolve: bool) -> None:
    """Strict: same columns.  Evolving: columns may be added or left out.
    Both: a column keeps its type (readers could not merge the files)."""
    old = {f.name.lower(): f.dataType for f in existing.fields}
    new = {f.name.lower(): f.dataType for f in incoming.fields}
    added = [c for c in new if c not in old]
    missing = [c for c in old if c not in new]
    if not evolve and (added or missing):
        raise ValueError(f"schema of {table} differs: new {added}, missing {missing}")
    changed = [c for c in new if c in old and new[c] != old[c]]
    if changed:
        raise ValueError(f"column types of {table} change: {changed}")


def _write_versioned(df: DataFrame, sink: Sink, table: str, mode: str, evolve: bool) -> None:
    """Overwrite without a window where the table is gone: the new version
    is written beside the old one and made current by a commit.  Append adds
    a folder (visible at its commit)."""
    spark = df.sparkSession
    family = TableFamily(spark, sink.root, sink.format)
    current = family.read(table)
    if current is not None and mode == "ignore":
        return
    if current is not None and mode in ("error", "errorifexists"):
        raise FileExistsError(f"{table} exists")
    if current is not None and mode == "append":
        _check_append(current.schema, df.schema, table, evolve)
        family.commit([family.stage_add(table, df)])
        return
    family.commit([family.stage(table, df)])


_COMMIT_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _commit_lock(root: str) -> threading.Lock:
    with _LOCKS_GUARD:
        return _COMMIT_LOCKS.setdefault(root, threading.Lock())


_COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("commit", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("op", T.StringType()),  # replace | add
        T.StructField("path", T.StringType()),  # "" = the bucket is empty
        T.StructField("rows", T.LongType()),  # rows written by this commit
        T.StructField("schema", T.StringType()),  # the table's merged schema (JSON)
        T.StructField("buckets", T.IntegerType()),  # the table's bucket count
        T.StructField("mark", T.StringType()),  # newest update time written (UTC text)
    ]
)


# Partition column of family tables; a name no document field will carry.
BUCKET_COLUMN = "__tablesync_bucket"


@dataclass
class Staged:
    """A written, not yet visible change of one table."""

    table: str
    entries: list  # (bucket, op, path)
    rows: int
    schema: T.StructType
    buckets: int = 1
    mark: str | None = None
    base: int | None = None  # the last commit it was built on


class CommitConflict(RuntimeError):
    """Another writer committed, or is committing, what this change was built on."""


class TableFamily:
    """A set of tables that change together (one table per document type).

    Layout: ``<root>/<table>/v-<id>/__tablesync_bucket=<b>/part-*`` plus a commit log
    ``<root>/.family/commits`` (JSON rows, appended by one Spark job per commit;
    no table name holds a dot, so no document type can reach that folder).
    Keyed tables are split into n buckets by ``pmod(xxhash64(key), n)``:
    an upsert rewrites only the buckets its changed keys fall in, so the
    cost follows the change, not the table.  n is chosen when a table is
    written in full -- ``buckets`` if given, else about one bucket per
    ``rows_per_bucket`` rows (small tables: one folder) -- and kept by its
    upserts.  For each (table, bucket) the
    log names the folder of the last ``replace`` and the folders ``add``-ed
    after it; the last commit of a table carries its merged schema, so
    readers need no footer merging.  Nothing is visible before its commit,
    and one commit covers every table of a batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        format: str = "parquet",
        buckets: int | None = None,
        key: str = "jira",
        rows_per_bucket: int = 1_000_000,
        mark_column: str | None = None,
        claim_minutes: float = 10.0,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.format = format
        self.buckets = buckets
        self.key = key
        self.rows_per_bucket = rows_per_bucket
        self.log = f"{self.root}/.family/commits"
        self.snapshots = f"{self.root}/.family/snapshots"
        self.claims = f"{self.root}/.family/claims"
        self.rejects = f"{self.root}/.family/rejects"
        self.claim_minutes = claim_minutes
        self.compact_every = 50
        self._counts: dict[str, int] = {}
        self._base: int | None = None  # the last commit that _state() saw
        self.mark_column = mark_column

    # -- reading ----------------------------------------------------------

    @staticmethod
    def bucket_of(key: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(int(n))).cast("int")

    def _bucket_count(self, df: DataFrame) -> int:
        if self.buckets:
            return int(self.buckets)
        rows = df.count()  # row count only: no column is decoded
        return max(1, -(-rows // self.rows_per_bucket))

    def _log(self) -> DataFrame | None:
        """The live part of the log: the latest snapshot (if any) plus the
        commits after it (partition pruning skips the older folders)."""
        from ..session import list_dirs, path_exists

        if not path_exists(self.spark, self.log):
            return None  # no commit yet
        commits = self.spark.read.schema(_COMMIT_SCHEMA).json(self.log)
        snaps = sorted(int(d.split("=", 1)[1]) for d in list_dirs(self.spark, self.snapshots) if d.startswith("upto="))
        if not snaps:
            return commits
        upto = snaps[-1]
        snap = self.spark.read.schema(_COMMIT_SCHEMA).json(f"{self.snapshots}/upto={upto}")
        return snap.unionByName(commits.where(F.col("commit") > upto))

    def compact(self) -> int | None:
        """Write a snapshot of the rows the state still needs: the last
        replace of every (table, bucket), the adds after it, and the row
        holding the newest mark.  Later reads skip every older commit."""
        log = self._log()
        if log is None:
            return None
        upto = int(log.agg(F.max("commit")).first()[0])
        last_replace = log.where(F.col("op") == "replace").groupBy("table", "bucket").agg(F.max("commit").alias("r"))
        keep = (
            log.join(last_replace, ["table", "bucket"], "left")
            .where(
                ((F.col("op") == "replace") & (F.col("commit") == F.col("r")))
                | ((F.col("op") == "add") & (F.col("r").isNull() | (F.col("commit") > F.col("r"))))
            )
            .drop("r")
        )
        top_mark = log.where(F.col("mark").isNotNull()).orderBy(F.col("mark").desc()).limit(1)  # the top-1 is the feature
        snap = keep.unionByName(top_mark).distinct().select(*[f.name for f in _COMMIT_SCHEMA.fields])
        snap.coalesce(1).write.mode("errorifexists").json(f"{self.snapshots}/upto={upto}")
        return upto

    def _state(self) -> tuple[dict[str, list[tuple[int, str]]], dict[str, T.StructType]]:
        """(table -> [(bucket, path)], table -> schema), from the log.

        The log is reduced by Spark; only the live folder list -- at most
        tables x buckets x appends -- reaches the driver.
        """
        log = self._log()
        self._base = 0
        if log is None:
            return {}, {}
        last_replace = log.where(F.col("op") == "replace").groupBy("table", "bucket").agg(F.max("commit").alias("r"))
        live = (
            log.join(last_replace, ["table", "bucket"], "left")
            .where(
                ((F.col("op") == "replace") & (F.col("commit") == F.col("r")))
                | ((F.col("op") == "add") & (F.col("r").isNull() | (F.col("commit") > F.col("r"))))
            )
            .where(F.col("path") != "")
            .select("table", "bucket", "path")
        )
        meta = log.groupBy("table").agg(
            F.max_by("schema", "commit").alias("schema"),
            F.max_by("buckets", "commit").alias("buckets"),
            F.max("commit").alias("last"),
        )
        paths: dict[str, list[tuple[int, str]]] = {}
        for r in live.collect():
            paths.setdefault(r["table"], []).append((r["bucket"], r["path"]))
        out_schemas = {}
        self._counts = {}
        for r in meta.collect():
            out_schemas[r["table"]] = T.StructType.fromJson(json.loads(r["schema"]))
            self._counts[r["table"]] = int(r["buckets"] or 1)
            self._base = max(self._base, int(r["last"]))
        return paths, out_schemas

    def bucket_counts(self) -> dict[str, int]:
        self._state()
        return dict(self._counts)

    def current(self) -> dict[str, list[str]]:
        """Live folders of each non-empty table."""
        paths, _ = self._state()
        return {t: sorted(p for _, p in v) for t, v in paths.items()}

    def mark(self) -> DataFrame | None:
        """One row ``last_update`` (UTC ``timestamp_ntz``): the newest update
        time ever committed, from the log -- no table is scanned.  ``None``
        without a log; a NULL mark when no commit recorded one."""
        log = self._log()
        if log is None:
            return None
        return log.agg(F.max(F.col("mark").try_cast(T.TimestampNTZType())).alias("last_update"))

    def vacuum(self, retain_commits: int = 10, min_age_hours: float = 24.0) -> list[str]:
        """Delete version folders no live bucket uses and no commit among the
        last ``retain_commits`` wrote (readers of recent versions keep their
        files).  Folders younger than ``min_age_hours`` stay: a change that is
        staged and not committed yet owns one.  Returns the deleted folders."""

        log = self._log()
        if log is None:
            return []
        last = self.last_commit()
        paths, schemas = self._state()
        keep = set()
        for entries in paths.values():
            keep.update(_version_dir(p) for _, p in entries)
        recent = log.where((F.col("commit") > last - retain_commits) & (F.col("path") != "")).select("path").distinct()
        keep.update(_version_dir(r[0]) for r in recent.collect())
        deleted = []
        for table in schemas:
            base = f"{self.root}/{table}"
            for name in list_dirs(self.spark, base):
                folder = f"{base}/{name}"
                old = age_hours(self.spark, folder) >= min_age_hours
                if name.startswith("v-") and folder not in keep and old:
                    delete_path(self.spark, folder)
                    deleted.append(folder)
        return deleted

    def last_commit(self) -> int:
        log = self._log()
        if log is None:
            return 0
        v = log.agg(F.max("commit")).first()[0]
        return int(v or 0)

    def _load(self, paths: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.format(self.format).schema(schema).load(paths)

    def _frame(self, table: str, paths, schemas) -> DataFrame | None:
        if table not in schemas:
            return None
        live = [p for _, p in paths.get(table, [])]
        if not live:  # every row deleted: the table exists, empty
            return self.spark.createDataFrame([], schemas[table])
        return self._load(live, schemas[table])

    def read(self, table: str) -> DataFrame | None:
        paths, schemas = self._state()
        return self._frame(table, paths, schemas)

    def read_all(self) -> dict[str, DataFrame]:
        paths, schemas = self._state()
        return {t: self._frame(t, paths, schemas) for t in sorted(schemas)}

    # -- writing ----------------------------------------------------------

    def _write(self, table: str, df: DataFrame, bucketed: bool) -> tuple[str, int, str | None]:
        """Write a folder; row count and newest update time are observed
        during the write (no extra pass)."""
        from ..functions.times import mark_as_utc, ntz_text

        path = f"{self.root}/{table}/v-{uuid.uuid4().hex}"
        obs = Observation(f"w_{uuid.uuid4().hex[:8]}")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if self.mark_column and self.mark_column in df.columns:
            m = mark_as_utc(F.col(f"`{self.mark_column}`"), df.schema[self.mark_column].dataType)
            metrics.append(ntz_text(F.max(m)).alias("mark"))
        data = df
        if bucketed:
            # Without a shuffle every task would write one file per bucket it
            # sees (tasks x buckets files).  REBALANCE groups rows by bucket and
            # lets AQE size the output: small buckets are coalesced and a hot
            # bucket (a key holding a third of the rows) is split over tasks.
            data = df.hint("rebalance", BUCKET_COLUMN)
        writer = data.observe(obs, *metrics).write.format(self.format).mode("errorifexists")
        if bucketed:
            writer = writer.partitionBy(BUCKET_COLUMN)
        writer.save(path)
        from ..operators.metrics import observed

        got = observed(obs)
        return path, int(got.get("rows") or 0), got.get("mark")

    def _bucket_dirs(self, path: str) -> dict[int, str]:
        from ..session import list_dirs

        out = {}
        for name in list_dirs(self.spark, path):
            if name.startswith(BUCKET_COLUMN + "="):
                out[int(name.split("=", 1)[1])] = f"{path}/{name}"
        return out

    def stage(self, table: str, df: DataFrame) -> Staged:
        """A full new version of ``table`` (every bucket replaced)."""
        if self.key in df.columns:
            n = self._bucket_count(df)
            data = df.withColumn(BUCKET_COLUMN, self.bucket_of(F.col(self.key), n))
            path, rows, mark = self._write(table, data, True)
            dirs = self._bucket_dirs(path)
            entries = [(b, "replace", dirs.get(b, "")) for b in range(n)]
            return Staged(table, entries, rows, df.schema, n, mark)
        path, rows, mark = self._write(table, df, False)  # no key: one bucket
        return Staged(table, [(0, "replace", path)], rows, df.schema, 1, mark)

    def stage_add(self, table: str, df: DataFrame) -> Staged:
        """Rows added to ``table`` in new folders (the old ones stay)."""
        _, schemas = self._state()
        merged = _merge_schema(schemas.get(table), df.schema)
        n = self.bucket_counts().get(table, 1)
        if self.key in df.columns and table in schemas:
            # keyed: added rows go to their key's bucket, so a later upsert
            # of that bucket sees them
            data = df.withColumn(BUCKET_COLUMN, self.bucket_of(F.col(self.key), n))
            path, rows, mark = self._write(table, data, True)
            entries = [(b, "add", d) for b, d in sorted(self._bucket_dirs(path).items())]
            return Staged(table, entries or [(0, "add", "")], rows, merged, n, mark)
        path, rows, mark = self._write(table, df, False)
        return Staged(table, [(0, "add", path)], rows, merged, n, mark)

    def touched_buckets(self, keys: DataFrame, n: int) -> list[int]:
        """Buckets the keys hash to (at most n values reach the driver)."""
        return sorted(r[0] for r in keys.select(self.bucket_of(F.col(self.key), n)).distinct().collect())

    def stage_upsert(self, table: str, keys: DataFrame, inserted: DataFrame | None, state=None, touched_cache=None) -> Staged | None:
        """Delete ``keys`` from ``table`` and add ``inserted``, rewriting
        only the buckets that hold one of the keys or receive a row.  A column whose type changes
        forces a rewrite of every bucket, as untouched files could not be
        read under the new type.  A table new to the family is written in
        full."""
        from ..operators.upsert import append_by_name, delete_by_keys

        paths, schemas = state if state is not None else self._state()
        if table not in schemas:
            return None if inserted is None else self.stage(table, inserted)
        n = self.bucket_counts().get(table, 1) if state is None else self._counts.get(table, 1)
        cache = touched_cache if touched_cache is not None else {}
        if n not in cache:
            cache[n] = self.touched_buckets(keys, n)
        touched = cache[n]
        live: dict[int, list[str]] = {}
        for b, p in paths.get(table, []):
            live.setdefault(b, []).append(p)  # a bucket's replace plus its adds
        if not live and inserted is None:
            return None  # empty or missing table, nothing to add
        old_schema = schemas.get(table)
        # Narrow the candidate buckets to those that really change: a bucket
        # holding one of the keys (found from the key column alone) or
        # receiving an inserted row.  Each changed document then costs about
        # one bucket in the whole family, not one per table.
        candidates = [b for b in touched if b in live]
        hits: set[int] = set()
        if candidates:
            key_only = self.spark.read.format(self.format).schema(
                T.StructType([old_schema[self.key]])
            ).load([p for b in candidates for p in live[b]])
            hits = {
                r[0]
                for r in key_only.join(keys.select(self.key).distinct(), self.key, "left_semi")
                .select(self.bucket_of(F.col(self.key), n))
                .distinct()
                .collect()
            }
        if inserted is not None and len(hits) < n:
            hits |= {r[0] for r in inserted.select(self.bucket_of(F.col(self.key), n)).distinct().collect()}
        touched = sorted(hits)
        if not touched:
            return None
        kept_paths = [p for b, ps in live.items() if b in set(touched) for p in ps]
        kept = self._load(kept_paths, old_schema) if kept_paths else None
        if kept is None and inserted is None:
            return None
        if kept is not None:
            kept = delete_by_keys(kept, keys, self.key)
        combined = inserted if kept is None else (kept if inserted is None else append_by_name(kept, inserted))
        buckets = sorted(set(touched))
        if old_schema is not None and _types_changed(old_schema, combined.schema):
            all_old = self._load([p for ps in live.values() for p in ps], old_schema) if live else None
            rest = delete_by_keys(all_old, keys, self.key) if all_old is not None else None
            combined = inserted if rest is None else (rest if inserted is None else append_by_name(rest, inserted))
            buckets = list(range(n))
        data = combined.withColumn(BUCKET_COLUMN, self.bucket_of(F.col(self.key), n))
        path, rows, mark = self._write(table, data, True)
        dirs = self._bucket_dirs(path)
        entries = [(b, "replace", dirs.get(b, "")) for b in buckets]
        return Staged(table, entries, rows, _merge_schema(old_schema, combined.schema), n, mark, self._base)

    def commit(self, staged) -> int:
        """Make staged changes visible at once (one append job).

        ``staged``: a list of :class:`Staged`, or ``{table: Staged}``.
        """
        items = [s for s in (staged.values() if isinstance(staged, dict) else staged) if s is not None]
        if not items:
            return self.last_commit()
        # threads of this driver take turns (the copies of a schema commit
        # table by table, concurrently); writers elsewhere meet at the claim
        with _commit_lock(self.root):
            n = self.last_commit() + 1
            claim = f"{self.claims}/{n}"
            if not create_file(self.spark, claim):
                # a claim outlives its writer only if that died before its commit, which takes seconds
                if age_hours(self.spark, claim) * 60 < self.claim_minutes or self.last_commit() >= n:
                    raise CommitConflict(f"another writer holds commit {n}")
                delete_path(self.spark, claim)
                if not create_file(self.spark, claim):
                    raise CommitConflict(f"another writer holds commit {n}")
            try:
                self._check_base(items)
                self._append(items, n)
            except BaseException:
                delete_path(self.spark, claim)  # nothing was committed under this number
                raise
            if self.compact_every and n % self.compact_every == 0:
                self.compact()
        return n

    def _check_base(self, items: list[Staged]) -> None:
        """A bucket built from an older version must not have changed since."""
        base = min((s.base for s in items if s.base is not None), default=None)
        log = self._log() if base is not None else None
        if log is None:
            return
        since = {(r["table"], r["bucket"]): r["c"] for r in log.where(F.col("commit") > base).groupBy("table", "bucket").agg(F.max("commit").alias("c")).collect()}
        for s in items:
            if s.base is not None and any(since.get((s.table, b), 0) > s.base for b, _, _ in s.entries):
                raise CommitConflict(f"{s.table} changed after this change was staged; stage it again")

    def _append(self, items: list[Staged], n: int) -> None:
        rows = []
        for s in items:
            schema = s.schema.json()
            for i, (b, op, path) in enumerate(s.entries):
                rows.append((n, s.table, int(b), op, path, s.rows if i == 0 else 0, schema, int(s.buckets), s.mark if i == 0 else None))
        (
            self.spark.createDataFrame(rows, _COMMIT_SCHEMA)
            .coalesce(1)
            .write.mode("append")
            .partitionBy("commit")
            .json(self.log)
        )


def _readable_as(old: T.DataType, new: T.DataType) -> bool:
    """Whether files written as ``old`` read correctly under ``new``: same
    type, or structs (also in arrays) that only gained fields."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        by_name = {f.name.lower(): f.dataType for f in new.fields}
        return all(f.name.lower() in by_name and _readable_as(f.dataType, by_name[f.name.lower()]) for f in old.fields)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return _readable_as(old.elementType, new.elementType)
    return old == new


def _version_dir(path: str) -> str:
    """``<root>/<table>/v-<id>`` of a bucket folder or version folder."""
    head, _, tail = path.rstrip("/").rpartition("/")
    return head if tail.startswith(BUCKET_COLUMN + "=") else path.rstrip("/")


def _types_changed(old: T.StructType, new: T.StructType) -> bool:
    """A column of the table changed in a way old files cannot follow."""
    before = {f.name.lower(): f.dataType for f in old.fields}
    return any(f.name.lower() in before and not _readable_as(before[f.name.lower()], f.dataType) for f in new.fields)


def _merge_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Old columns first (new types win), then columns that are new."""
    if old is None:
        return new
    by_name = {f.name.lower(): f for f in new.fields}
    fields = [by_name.get(f.name.lower(), f) for f in old.fields]
    seen = {f.name.lower() for f in old.fields}
    fields += [f for f in new.fields if f.name.lower() not in seen]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


# --------------------------------------------------------------------------
# table formats with MERGE (Delta, Iceberg): the family's job is done by SQL
# --------------------------------------------------------------------------

def _ident(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def merge_delete_sql(table: str, keys_view: str, key: str = "jira") -> str:
    """Remove every changed key from one table (a type change moves a row)."""
    return (
        f"MERGE INTO {_ident(table)} AS t USING (SELECT DISTINCT {_ident(key)} FROM {_ident(keys_view)}) AS k "
        f"ON t.{_ident(key)} = k.{_ident(key)} WHEN MATCHED THEN DELETE"
    )


def merge_upsert_sql(table: str, changes_view: str, key: str = "jira") -> str:
    """Replace or insert the changed rows of one table, matched by key."""
    return (
        f"MERGE INTO {_ident(table)} AS t USING {_ident(changes_view)} AS s "
        f"ON t.{_ident(key)} = s.{_ident(key)} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def merge_family(spark: SparkSession, tables: list[str], keys: DataFrame, changes_by_table: dict[str, DataFrame], key: str = "jira") -> None:
    """Incremental upsert on catalog tables of a format with MERGE INTO.

    Each statement is atomic per table (the format's own commit), so unlike
    :class:`TableFamily` the tables do not switch together.  New tables are
    created from their first rows.  Needs the format's jar and catalog; not
    available in the test environment (the statements are unit-tested).
    """
    view = f"_tablesync_keys_{uuid.uuid4().hex[:8]}"
    keys.select(key).createOrReplaceTempView(view)
    try:
        for t in tables:
            spark.sql(merge_delete_sql(t, view, key))
        for t, rows in changes_by_table.items():
            if spark.catalog.tableExists(t):
                cv = f"_tablesync_rows_{uuid.uuid4().hex[:8]}"
                rows.createOrReplaceTempView(cv)
                try:
                    spark.sql(merge_upsert_sql(t, cv, key))
                finally:
                    spark.catalog.dropTempView(cv)
            else:
                rows.writeTo(t).create()
    finally:
        spark.catalog.dropTempView(view)
