"""JDBC reader calls, checked without a database (none may be started here)."""

from tablesync.sources.relational import (
    ORACLE_DRIVER,
    ORACLE_FETCHSIZE,
    POSTGRESQL_DRIVER,
    TableSource,
    jdbc_url,
    read_table,
    size_sql,
)


class _Reader:
    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((url, table, predicates, properties))
        return "frame"


class _Spark:
    def __init__(self):
        self.read = _Reader()


def test_postgresql_scan_call():
    spark = _Spark()
    src = TableSource(url="jdbc:postgresql://db/x", driver=POSTGRESQL_DRIVER, schema="public")
    assert read_table(spark, src, "t") == "frame"
    assert spark.read.calls == [("jdbc:postgresql://db/x", '"public"."t"', None, {"driver": POSTGRESQL_DRIVER})]


def test_oracle_scan_call_with_fetchsize_and_predicates():
    spark = _Spark()
    src = TableSource(url="jdbc:oracle:thin:@h:1521/s", driver=ORACLE_DRIVER, schema="HR", fetchsize=ORACLE_FETCHSIZE)
    read_table(spark, src, "EMP", predicates=["a < 1", "a >= 1"])
    url, table, preds, props = spark.read.calls[0]
    assert table == '"HR"."EMP"' and preds == ["a < 1", "a >= 1"]
    assert props == {"driver": ORACLE_DRIVER, "fetchsize": "10000"}


def test_url_prefix_and_size_sql():
    assert jdbc_url("postgresql://h/db") == "jdbc:postgresql://h/db"
    assert jdbc_url("jdbc:postgresql://h/db") == "jdbc:postgresql://h/db"
    assert size_sql("public.o'x") == "(SELECT pg_total_relation_size('public.o''x') AS size_bytes) AS s"


def test_bounds_run_in_the_database():
    from tablesync.sources.relational import bounds_sql, source_bounds

    class _Row(tuple):
        pass

    class _Frame:
        def first(self):
            return (1, 99, 50)

    class _R(_Reader):
        def jdbc(self, url, table, predicates=None, properties=None):
            self.calls.append((url, table, predicates, properties))
            return _Frame()

    spark = _Spark()
    spark.read = _R()
    src = TableSource(url="jdbc:postgresql://db/x", driver=POSTGRESQL_DRIVER, schema="s")
    assert source_bounds(spark, src, "t", "id") == (1, 99, 50)
    assert spark.read.calls[0][1] == bounds_sql('"s"."t"', "id") == '(SELECT MIN(id) AS lo, MAX(id) AS hi, COUNT(*) AS n FROM "s"."t") b'


def test_schema_copy_wiring(monkeypatch):
    from tablesync.plans import jobs

    seen = {}
    monkeypatch.setattr(jobs.cat, "jdbc_catalog", lambda spark, url, schema, exclude, only, dialect, props: (url, schema, exclude, only, dialect, props))
    monkeypatch.setattr(jobs, "copy_schema", lambda spark, source, tables, sink, **kw: seen.update(source=source, tables=tables, kw=kw))
    jobs.copy_postgresql_schema(None, "postgresql://h/db", "public", sink=None, exclude=["a"], only=["b"])
    assert seen["source"].driver == POSTGRESQL_DRIVER and seen["source"].schema == "public"
    assert seen["tables"] == ("jdbc:postgresql://h/db", "public", ["a"], ["b"], "postgresql", {"driver": POSTGRESQL_DRIVER})
    assert seen["kw"]["evolve"] is True
    jobs.copy_oracle_schema(None, "oracle:thin:@h:1521/s", "HR", sink=None, drop_unsupported=True)
    assert seen["source"].fetchsize == ORACLE_FETCHSIZE and seen["source"].driver == ORACLE_DRIVER
    assert seen["tables"][4] == "oracle" and seen["kw"]["drop_unsupported"] is True
    assert seen["kw"]["size_partitioning"] is False


def test_hash_partitioned_scan_predicates():
    from tablesync.sources.relational import read_table_partitioned

    class _Frame:
        def first(self):
            return (2_500_000,)

    class _R(_Reader):
        def jdbc(self, url, table, predicates=None, properties=None):
            self.calls.append((url, table, predicates, properties))
            return _Frame() if table.startswith("(SELECT COUNT") else "frame"

    spark = _Spark()
    spark.read = _R()
    src = TableSource(url="jdbc:oracle:thin:@h:1521/s", driver=ORACLE_DRIVER, schema="HR")
    assert read_table_partitioned(spark, src, "EMP", key="code", hash_expr="ORA_HASH(code)") == "frame"
    count_call, scan_call = spark.read.calls
    assert count_call[1] == '(SELECT COUNT(*) AS n FROM "HR"."EMP") c'
    assert len(scan_call[2]) == 3 and scan_call[2][2] == "MOD(ORA_HASH(code), 3) = 2"


def test_spark_catalog_namespace(spark):
    from tablesync.sources import catalog as cat

    spark.range(1).createOrReplaceTempView("tmp_a")
    spark.range(1).createOrReplaceTempView("tmp_b")
    names = {r[0] for r in cat.spark_catalog(spark, "default", exclude=["tmp_b"]).collect()}
    assert "tmp_a" in names and "tmp_b" not in names


def test_merge_statements():
    from tablesync.plans.sinks import merge_delete_sql, merge_upsert_sql

    assert merge_delete_sql("db.Bug", "keys") == (
        "MERGE INTO `db`.`Bug` AS t USING (SELECT DISTINCT `jira` FROM `keys`) AS k "
        "ON t.`jira` = k.`jira` WHEN MATCHED THEN DELETE"
    )
    assert merge_upsert_sql("db.Bug", "rows") == (
        "MERGE INTO `db`.`Bug` AS t USING `rows` AS s ON t.`jira` = s.`jira` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


class _Probed(_Reader):
    """Answers count and split statements; scans are kept."""

    def __init__(self, rows, points):
        super().__init__()
        self.rows, self.points = rows, points

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((url, table, predicates, properties))

        class _Frame:
            first = lambda _self: (self.rows,)
            collect = lambda _self: [(p,) for p in self.points]

        return _Frame() if table.startswith("(") else "frame"


def test_equal_depth_statements_and_predicates():
    from decimal import Decimal

    from tablesync.sources.relational import depth_predicates, read_table_partitioned, split_sql

    assert split_sql('"s"."t"', '"Id"', 4, "SAMPLE BLOCK (1)") == (
        '(SELECT MIN(k) AS lo FROM (SELECT "Id" AS k, NTILE(4) OVER (ORDER BY "Id") AS t FROM "s"."t" SAMPLE BLOCK (1) '
        'WHERE "Id" IS NOT NULL) q GROUP BY t) b'
    )
    spark = _Spark()
    spark.read = _Probed(3_500_000, [Decimal("70"), Decimal("5"), Decimal("9"), Decimal("9")])
    src = TableSource(url="jdbc:postgresql://db/x", driver=POSTGRESQL_DRIVER, schema="s")
    assert read_table_partitioned(spark, src, "t", key='I"d') == "frame"
    count, split, scan = spark.read.calls
    assert count[1] == '(SELECT COUNT(*) AS n FROM "s"."t") c' and "NTILE(4)" in split[1] and '"I""d" AS k' in split[1]
    assert scan[2] == ['("I""d" < 9) OR "I""d" IS NULL', '"I""d" >= 9 AND "I""d" < 70', '"I""d" >= 70']
    assert depth_predicates("k", []) == ["1 = 1"] and depth_predicates("k", ["a'b"])[1] == "k >= 'a''b'"


def test_keys_of_a_schema(monkeypatch):
    from tablesync.plans import jobs
    from tablesync.sources.catalog import keys_sql

    assert keys_sql("o's").endswith("c.table_schema = 'o''s' AND k.ordinal_position = 1 AND d.data_type IN ('smallint', 'integer', 'bigint', 'numeric')")
    assert "all_cons_columns" in keys_sql("HR", "oracle") and "c.owner = 'HR'" in keys_sql("HR", "oracle")
    seen = {}
    monkeypatch.setattr(jobs.cat, "jdbc_catalog", lambda *a: None)
    monkeypatch.setattr(jobs.cat, "jdbc_keys", lambda spark, url, schema, dialect, props: {"T": f"{dialect}-key"})
    monkeypatch.setattr(jobs, "copy_schema", lambda spark, source, tables, sink, **kw: seen.update(source=source, **kw))
    jobs.copy_postgresql_schema(None, "u", "s", sink=None, partition_keys="catalog")
    assert seen["partition_keys"] == {"T": "postgresql-key"}
    jobs.copy_oracle_schema(None, "u", "s", sink=None, partition_keys="catalog", fetchsize=None)
    assert seen["partition_keys"] == {"T": "oracle-key"} and seen["source"].jdbc_properties() == {"driver": ORACLE_DRIVER}


def test_equal_depth_of_a_skewed_key(spark):
    from pyspark.sql import functions as F

    from tablesync.sources.relational import depth_predicates

    keys = [None] * 50 + [0] * 300 + [2**k for k in range(40)] * 20 + list(range(10_000, 11_000))
    df = spark.createDataFrame([(k,) for k in keys], "k long").cache()
    points = df.agg(F.percentile_approx("k", [i / 6 for i in range(1, 6)], 600)).first()[0]
    counts = [df.where(p).count() for p in depth_predicates("k", points)]
    assert sum(counts) == len(keys) and len(counts) == 6
    assert all(df.where(f"({a}) AND ({b})").count() == 0 for i, a in enumerate(depth_predicates("k", points)) for b in depth_predicates("k", points)[:i])


def test_copies_begin_with_the_largest_in_pools_of_their_own(spark, monkeypatch):
    from tablesync.plans import jobs

    begun = []

    def copied(spark, source, name, sink, **kw):
        begun.append((name, spark.sparkContext.getLocalProperty("spark.scheduler.pool"), kw.get("partition_key")))
        if name == "b":
            raise ValueError("no")
        return (name, 1, "ok", None)

    monkeypatch.setattr(jobs, "copy_table", copied)
    tables = spark.createDataFrame([("a", 5), ("b", 900), ("c", 40)], "table_name string, bytes long")
    source = TableSource(url="jdbc:postgresql://db/x", driver=POSTGRESQL_DRIVER, schema="s")
    out = jobs.copy_schema(spark, source, tables, None, parallelism=1, partition_keys={"c": "id"}, partition_key="k").collect()
    assert begun == [("b", "copy:b", "k"), ("c", "copy:c", "id"), ("a", "copy:a", "k")]
    assert [(r.table_name, r.status) for r in out] == [("a", "ok"), ("b", "failed"), ("c", "ok")]
