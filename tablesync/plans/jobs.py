"""Composite jobs: copy a table, copy a schema (JDBC, folder), synchronise
documents (full refresh or incremental upsert into a table family)."""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..operators import coerce, documents, routing, upsert, watermark
from ..operators.metrics import observe_rows
from ..operators.metrics import observed as observed_metrics
from ..operators.partitioning import size_partitions
from ..session import case_sensitive, delete_path, scratch_path
from ..sources import catalog as cat
from ..sources.relational import ORACLE_FETCHSIZE, TableSource, read_table, read_table_partitioned, table_size_bytes
from .sinks import Sink, TableFamily, write_table

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


BROADCAST_KEYS = 100_000  # keys of a batch, with a time each, that are broadcast to the stored rows

STAGING_SCHEMA = T.StructType(
    [
        T.StructField("jira", T.StringType()),
        T.StructField("doc", T.VariantType()),
        T.StructField("_subtask", T.BooleanType()),
        T.StructField("_type", T.StringType()),
        T.StructField("_reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)


def prepare_table(
    spark: SparkSession,
    source: TableSource,
    table: str,
    decimals: str = "float",
    drop_unsupported: bool = False,
    clean_strings: bool = False,
    partition_key: str | None = None,
    size_bytes: int | None = None,
    size_partitioning: bool | str = "auto",
    partition_hash: str | None = None,
) -> DataFrame:
    """The lazy plan of one table copy, up to (not including) the write.

    ``partition_key`` (integer key) or ``partition_hash`` (a hash expression
    in the database's dialect) splits a JDBC scan into parallel tasks.

    ``size_partitioning``: ``True`` shuffles into partitions of 9 MiB of the
    table's size (for connectors that need that many small loads); ``"auto"``
    rebalances only what one JDBC connection reads, so that it is written by
    many tasks, and keeps the partitions of a scan that is split already.
    """
    if (partition_key or partition_hash) and source.format == "jdbc":
        df = read_table_partitioned(spark, source, table, partition_key, hash_expr=partition_hash)
    else:
        df = read_table(spark, source, table)
    if drop_unsupported:
        df = coerce.drop_types(df)
    df = coerce.decimals_to(df, decimals)
    if clean_strings:
        df = coerce.clean_strings(df)
    if size_partitioning == "auto":
        if source.format == "jdbc" and not (partition_key or partition_hash):
            df = df.hint("rebalance")
    elif size_partitioning:
        size = size_bytes if size_bytes is not None else table_size_bytes(spark, source, table)
        df = size_partitions(df, size)
    return df


def copy_table(spark: SparkSession, source: TableSource, table: str, sink: Sink, mode: str = "overwrite", evolve: bool = False, **prepare) -> tuple:
    """Copy one table; the row count is measured during the write (one scan)."""
    df = prepare_table(spark, source, table, **prepare)
    watched, obs = observe_rows(df)
    write_table(watched, sink, table, mode=mode, evolve=evolve)
    rows = observed_metrics(obs).get("rows")
    return (table, int(df.count() if rows is None else rows), "ok", None)


def copy_schema(
    spark: SparkSession,
    source: TableSource,
    tables: DataFrame | list[str],
    sink: Sink,
    mode: str = "overwrite",
    evolve: bool = False,
    parallelism: int = 4,
    partition_keys: dict[str, str] | None = None,
    **prepare,
) -> DataFrame:
    """Copy every table of a catalogue.

    The catalogue is read once (its names are metadata); tables are copied
    by a bounded pool of driver threads, each submitting its own Spark jobs.
    With the FAIR scheduler every table has a pool of its own, so a small table's
    tasks do not queue behind a big one's.  The largest tables begin first where
    their sizes are known, so none of them is left for the end.  ``partition_keys``
    names the key each table's JDBC scan is split by.  A failing table is
    reported in the result frame and does not stop the others.
    """
    sizes = {}
    if isinstance(tables, list):
        names = tables
    elif "bytes" in tables.columns:
        sizes = dict(tables.select("table_name", "bytes").collect())
        names = list(sizes)
    else:
        names = [r[0] for r in tables.select("table_name").collect()]
    if not sizes and len(names) > parallelism and source.sized:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            sizes = dict(zip(names, pool.map(lambda n: table_size_bytes(spark, source, n), names)))
    order = sorted(names, key=lambda n: -(sizes.get(n) or 0))

    def one(name: str) -> tuple:
        spark.sparkContext.setJobGroup(f"copy:{name}", f"copy table {name}")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"copy:{name}")
        own = dict(prepare)
        if partition_keys and name in partition_keys:
            own["partition_key"] = partition_keys[name]
        if name in sizes:
            own.setdefault("size_bytes", sizes[name])
        try:
            return copy_table(spark, source, name, sink, mode=mode, evolve=evolve, **own)
        except Exception as exc:  # noqa: BLE001 - isolate per table
            return (name, None, "failed", "".join(traceback.format_exception_only(type(exc), exc)).strip())

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = dict(zip(order, pool.map(one, order)))
    return spark.createDataFrame([results[n] for n in names], RESULT_SCHEMA)


def copy_catalog(
    spark: SparkSession,
    source: TableSource,
    catalog: DataFrame,
    schema: str | None,
    sink: Sink,
    exclude=None,
    only=None,
    **kw,
) -> DataFrame:
    """Catalogue filter, then :func:`copy_schema`."""
    keep = ("bytes",) if "bytes" in catalog.columns else ()
    return copy_schema(spark, source, cat.filter_catalog(catalog, schema, exclude, only, keep), sink, **kw)


def copy_postgresql_schema(
    spark: SparkSession,
    url: str,
    schema: str,
    sink: Sink,
    mode: str = "overwrite",
    exclude=None,
    only=None,
    partition_key: str | None = None,
    partition_keys: dict[str, str] | str | None = None,
    **kw,
) -> DataFrame:
    """Copy a PostgreSQL schema: catalogue from ``information_schema``,
    qualified table names, size-based output partitions, evolving writes.

    ``partition_keys``: the key each table's scan is split by, or ``"catalog"`` for the
    numeric first columns of the primary keys; ``partition_key`` is one for all tables."""
    from ..sources.relational import POSTGRESQL_DRIVER, jdbc_url

    url = jdbc_url(url)
    source = TableSource(format="jdbc", url=url, driver=POSTGRESQL_DRIVER, schema=schema)
    tables = cat.jdbc_catalog(spark, url, schema, exclude, only, "postgresql", {"driver": POSTGRESQL_DRIVER})
    kw.setdefault("evolve", True)
    if partition_keys == "catalog":
        partition_keys = cat.jdbc_keys(spark, url, schema, "postgresql", {"driver": POSTGRESQL_DRIVER})
    if partition_keys:
        kw["partition_keys"] = partition_keys
    return copy_schema(spark, source, tables, sink, mode=mode, partition_key=partition_key, **kw)


def copy_oracle_schema(
    spark: SparkSession,
    url: str,
    owner: str,
    sink: Sink,
    mode: str = "overwrite",
    exclude=None,
    drop_unsupported: bool = False,
    fetchsize: int | None = ORACLE_FETCHSIZE,
    partition_key: str | None = None,
    partition_keys: dict[str, str] | str | None = None,
    **kw,
) -> DataFrame:
    """Copy an Oracle owner's tables (``all_tables``); optional dropping of
    binary/map/array columns; strict writes; no size probe (none exists).
    ``fetchsize=None`` leaves the driver's default; ``partition_keys`` as for PostgreSQL."""
    from ..sources.relational import ORACLE_DRIVER, jdbc_url

    url = jdbc_url(url)
    source = TableSource(format="jdbc", url=url, driver=ORACLE_DRIVER, schema=owner, fetchsize=fetchsize)
    tables = cat.jdbc_catalog(spark, url, owner, exclude, None, "oracle", {"driver": ORACLE_DRIVER})
    kw.setdefault("size_partitioning", False)  # the partitioned scan sets the parallelism
    if partition_keys == "catalog":
        partition_keys = cat.jdbc_keys(spark, url, owner, "oracle", {"driver": ORACLE_DRIVER})
    if partition_keys:
        kw["partition_keys"] = partition_keys
    return copy_schema(spark, source, tables, sink, mode=mode, drop_unsupported=drop_unsupported, partition_key=partition_key, **kw)


# --------------------------------------------------------------------------
# documents
# --------------------------------------------------------------------------

def latest_per_key(docs: DataFrame) -> DataFrame:
    """One document per key: the one with the latest ``fields.updated``.

    ``max_by`` in a hash aggregate: partial results are combined map-side,
    so a key repeated in a third of the batch is reduced before the shuffle
    instead of landing whole in one task (the aggregate is sort-based, as
    the kept value is a variable-width document, so it spills rather than
    fails).  Documents without a key are kept as they are.
    """
    key = documents.key_of("doc")
    updated = F.coalesce(
        times.parse_mark(F.try_variant_get(F.col("doc"), "$.fields.updated", "string")),
        F.lit("0001-01-01 00:00:00").cast(T.TimestampNTZType()),
    )
    cols = [c for c in docs.columns]
    # A document without a key gets a group of its own (a surrogate that no
    # key can equal), so it is kept as it is -- no filter and no union: a
    # filter on the parsed key would be pushed below the parse and parse
    # every document twice.
    group = F.coalesce(key, F.concat(F.lit("\u0001"), F.monotonically_increasing_id().cast("string")))
    return (
        docs.withColumn("_g", group)
        .withColumn("_u", updated)
        .groupBy("_g")
        .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("_u")).alias("_w"))
        .select("_w.*")
    )


def read_mark(family: TableFamily, column: str = watermark.UPDATED_COLUMN):
    """(mark as UTC timestamp_ntz, API filter text) or (None, None).

    From the commit log when the family records marks (no table scanned);
    otherwise the max of ``column`` over the union of all tables.  Missing
    tables count as empty; no table or no value means full refresh.
    """
    logged = family.mark()
    if logged is not None:
        row = watermark.mark_text(logged).first()
        if row is not None and row["last_update"] is not None:
            return row["last_update"], row["mark_text"]
    targets = [t for t in family.read_all().values() if column in t.columns]
    if not targets:
        return None, None
    row = watermark.mark_text(watermark.high_water_mark(targets, column)).first()
    if row is None or row["last_update"] is None:
        return None, None
    return row["last_update"], row["mark_text"]


def sync_documents(
    spark: SparkSession,
    fetch: Callable[[str | None], DataFrame],
    family: TableFamily,
    field_map: dict[str, str] | None = None,
    exclude_fields=(),
    exclude_types=(),
    types: DataFrame | None = None,
    updated_column: str = watermark.UPDATED_COLUMN,
    force_full: bool = False,
    parallelism: int = 8,
    dedupe_keys: bool = True,
    keep_staging: bool = False,
    upsert_only: bool = False,
    keep_newest: bool = False,
) -> DataFrame:
    """Full refresh or incremental upsert of a document collection.

    1. high-water mark from the family's commit log (scanning the targets
       only for logs without marks) -> API filter text (none -> full);
    2. ``fetch(since)`` -> raw documents; parsed and written once to a
       staging folder under the checkpoint root, partitioned by raw type
       (the API is read once; everything later re-reads the staged files,
       which survive the loss of an executor);
    3. per-type schemas merged by an Observation on that same staging job;
    4. incremental: every changed key leaves every table (a type change
       moves the document) -- only buckets that hold a changed key or
       receive a row are rewritten -- and each type's rows are added by
       name; full: each type
       present in the batch replaces its table;
    5. all changes are committed together; the staging folder is dropped, also
       when a step fails.

    Documents that cannot be parsed or routed (no type, an empty type name, a
    type that the metadata lists as task and as sub-task and that carries no
    flag) go to the folder ``family.rejects`` with the reason; their keys delete
    nothing.  The result's ``rejected`` counts them.

    ``dedupe_keys`` keeps one document per key (the latest update): a parallel
    offset read may see a document twice.  ``upsert_only`` applies the batch as
    changes whatever the mark says; ``keep_newest`` leaves out documents older
    than the stored row of their key.
    """
    if family.mark_column is None:
        family.mark_column = updated_column
    since_ts, since_text = (None, None) if force_full else read_mark(family, updated_column)
    incremental = since_text is not None or upsert_only

    # only the parsed document travels on; the text stays for documents that do not parse
    batch = documents.parse(fetch(since_text))
    batch = batch.select("doc", F.when(F.col("doc").isNull(), F.col("raw")).alias("raw"))
    batch = routing.with_type(batch)
    if types is not None:
        batch = routing.attach_subtask(batch, types)
    else:
        batch = batch.withColumn("_ambiguous", F.lit(False))
    if dedupe_keys:
        batch = latest_per_key(batch)
    reason = (
        F.when(F.col("doc").isNull(), F.lit("not a JSON document"))
        .when(F.coalesce(F.trim("_type"), F.lit("")) == "", F.lit("no type"))
        .when(F.col("_ambiguous"), F.lit("task or sub-task"))
    )
    batch = batch.withColumn("_reason", reason).withColumn("_type", F.when(reason.isNull(), F.col("_type")))
    staging = scratch_path(spark, "staging")
    try:
        return _sync_staged(
            spark, batch, staging, family, field_map, exclude_fields, exclude_types, updated_column, incremental, parallelism, keep_newest
        )
    finally:
        if not keep_staging:
            delete_path(spark, staging)  # what succeeded lives in the committed versions
            delete_path(spark, f"{staging}-late")


def late_keys(family: TableFamily, batch: DataFrame, column: str, rows: int) -> DataFrame | None:
    """Keys of the batch (jira, _own) whose stored row is newer.

    Only the buckets that the batch's keys hash to are read, and of them the key and the
    update column.  While the batch has few documents its keys are broadcast, so no stored
    row is shuffled; a larger batch is joined as Spark sees fit.
    """
    paths, schemas = family._state()
    mine = F.broadcast(batch) if rows <= BROADCAST_KEYS else batch
    touched: dict[int, set[int]] = {}
    late = []
    for table, schema in schemas.items():
        if column not in schema.fieldNames() or "jira" not in schema.fieldNames():
            continue
        n = family._counts.get(table, 1)
        if n not in touched:
            touched[n] = set(family.touched_buckets(batch, n))
        live = [p for b, p in paths.get(table, []) if b in touched[n]]
        if live:
            stored = family._load(live, T.StructType([schema["jira"], schema[column]]))
            mark = times.mark_as_utc(F.col(f"`{column}`"), schema[column].dataType)
            found = stored.select("jira", mark.alias("_stored")).join(mine, "jira")
            late.append(found.where(F.col("_own") < F.col("_stored")).select("jira"))
    return upsert.union_all(late).distinct() if late else None


def _sync_staged(
    spark, batch, staging, family, field_map, exclude_fields, exclude_types, updated_column, incremental, parallelism, keep_newest
) -> DataFrame:
    """Steps 2 to 5 of :func:`sync_documents`."""
    # Staged once, partitioned by the raw type: the API is read once and
    # each type's typing pass prunes to its own folder.  The parsed VARIANT
    # is staged (Parquet stores it natively), so typing reads binary values.
    # The same job counts the documents and merges every (type, flag)
    # group's schema through an Observation -- no separate schema pass.
    # (Schema merging is idempotent, so a re-run task cannot distort it.)
    # (The key is encoded: names that differ by case only are different groups.)
    pair = F.concat(F.col("_type"), F.lit("|"), F.coalesce(F.col("_subtask"), F.lit(False)).cast("string"))
    group_key = F.concat(F.lit("k"), F.hex(F.encode(pair, "UTF-8")))
    observed = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    to_stage = (
        batch.withColumn("_schema_in", F.when(F.col("_type").isNotNull(), documents.keyed_schema_input(F.col("doc"), group_key)))
        .observe(
            observed,
            F.count(F.lit(1)).alias("rows"),
            F.count("_reason").alias("rejected"),
            F.expr("schema_of_variant_agg(_schema_in)").alias("schemas"),
        )
        .select(
            F.coalesce(F.col("_subtask"), F.lit(False)).alias("_subtask"),
            "_type",
            documents.key_of("doc").alias("jira"),
            "doc",
            "_reason",
            "raw",
        )
    )
    # REBALANCE by type before the partitioned write: one file per task and
    # type otherwise; AQE coalesces small types and splits a hot one.
    with case_sensitive(spark):
        (
            to_stage.hint("rebalance", "_subtask", "_type")
            .write.mode("errorifexists")
            .partitionBy("_subtask", "_type")
            .parquet(staging)
        )
    # explicit schema: partition values are not type-guessed (a type named
    # "2024" stays a string, the flag is a boolean)
    staged = spark.read.schema(STAGING_SCHEMA).parquet(staging)
    metrics = observed_metrics(observed)
    rejected = int(metrics.get("rejected") or 0)
    if rejected:
        # the whole document, as text where it did not parse
        lost = staged.where(F.col("_reason").isNotNull())
        lost.select("jira", F.col("_reason").alias("reason"), F.coalesce("raw", F.to_json("doc")).alias("document")).write.mode(
            "append"
        ).parquet(family.rejects)
    staged = staged.where(F.col("_reason").isNull())
    if keep_newest:
        own = staged.select("jira", times.parse_mark(F.try_variant_get(F.col("doc"), "$.fields.updated", "string")).alias("_own"))
        late = late_keys(family, own, (field_map or {}).get("updated", "updated"), int(metrics.get("rows") or 0))
        if late is not None:
            # written once: every type's rows are filtered by it
            late_path = f"{staging}-late"
            late.write.parquet(late_path)
            staged = staged.join(spark.read.schema(late.schema).parquet(late_path), "jira", "left_anti")
    per_key = documents.split_keyed_schemas(metrics.get("schemas"))
    per_pair = {}
    for k, schema in per_key.items():
        name, _, flag = bytes.fromhex(k[1:]).decode("utf-8").rpartition("|")
        if name in set(exclude_types):
            continue
        per_pair[(name, flag == "true")] = schema
    wanted = staged if not exclude_types else staged.where(~F.col("_type").isin(list(exclude_types)))
    state = family._state()
    names = routing.target_names(per_pair.keys(), state[1])
    protected = (documents.KEY_COLUMN, updated_column)
    batch_by_target: dict[str, DataFrame] = {}
    for pair, (ft, ct) in per_pair.items():
        t = names[pair]
        rows = wanted.where((F.col("_type") == pair[0]) & (F.col("_subtask") == F.lit(bool(pair[1]))))
        flat = documents.flatten(rows, ft, ct, field_map, exclude_fields, protected=protected)
        batch_by_target[t] = upsert.append_by_name(batch_by_target[t], flat) if t in batch_by_target else flat
    if incremental:
        # every changed key leaves every table (a type change moves the
        # document); only the buckets those keys hash to are rewritten
        keys = staged.select("jira")
        tables = sorted(set(state[1]) | set(batch_by_target))
        touched_cache: dict[int, list[int]] = {}
        for n in sorted(set(family._counts.get(t, 1) for t in tables)):
            touched_cache[n] = family.touched_buckets(keys, n)

        def stage_one(t):
            return family.stage_upsert(t, keys, batch_by_target.get(t), state, touched_cache)
    else:
        tables = sorted(batch_by_target)

        def stage_one(t):
            return family.stage(t, batch_by_target[t])

    # one write job per table, submitted by a bounded pool so small types
    # do not wait behind a big one; nothing is visible before the commit
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        staged_tables = [x for x in pool.map(stage_one, tables) if x is not None]
    commit = family.commit(staged_tables)
    n_fetched = int(metrics.get("rows") or 0)
    mode = "incremental" if incremental else "full"
    rows = [(x.table, x.rows, mode, commit, n_fetched, rejected) for x in staged_tables]
    return spark.createDataFrame(
        rows, "table_name string, rows bigint, mode string, commit bigint, fetched bigint, rejected bigint"
    )
