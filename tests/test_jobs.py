import json
import os

import pytest
from pyspark.sql import functions as F

from tablesync.plans.jobs import copy_schema, sync_documents
from tablesync.plans.sinks import Sink, TableFamily, read_written, write_table
from tablesync.sources.relational import TableSource

FIELD_MAP = {"updated": "Mise_a_jour"}


def doc(key, typ, updated, subtask=False, **extra):
    fields = {"issuetype": {"name": typ, "subtask": subtask}, "updated": updated, **extra}
    return {"key": key, "id": key.split("-")[-1], "fields": fields, "changelog": {"histories": []}}


def fetcher(spark, batches, seen):
    it = iter(batches)

    def fetch(since):
        seen.append(since)
        return spark.createDataFrame([(json.dumps(d),) for d in next(it)], "raw string")

    return fetch


def state(family):
    return {t: sorted((r["jira"], r.asDict().get("x")) for r in df.collect()) for t, df in family.read_all().items()}


def test_full_then_incremental(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    first = [
        doc("P-1", "Bug", "2024-03-05T10:11:12.123+1100"),
        doc("P-2", "Tâche", "2024-03-05T10:12:00.000+1100"),
        doc("P-3", "Tâche", "2024-03-05T10:13:00.000+1100"),
        doc("P-4", "Sous-tâche", "2024-03-05T10:14:00.000+1100", subtask=True),
    ]
    # P-2 moves to Bug with a new field; P-4 (excluded type) is changed
    second = [
        doc("P-2", "Bug", "2024-03-05T11:00:00.000+1100", x=7),
        doc("P-4", "Sous-tâche", "2024-03-05T11:01:00.000+1100", subtask=True),
    ]
    seen = []
    fetch = fetcher(spark, [first, second, second], seen)
    r1 = sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    assert {r.table_name for r in r1.collect()} == {"Bug", "Tache", "Sous_tache_subtask"}
    assert seen == [None]
    s1 = state(fam)
    assert s1["Bug"] == [("P-1", None)] and s1["Tache"] == [("P-2", None), ("P-3", None)]
    assert fam.read("Bug").first()["Mise_a_jour"] == "2024-03-04 23:11:12.123000"

    sync_documents(spark, fetch, fam, field_map=FIELD_MAP, exclude_types=["Sous-tâche"])
    assert seen[1] == "2024/03/05 10:14"  # local minute of the newest update
    s2 = state(fam)
    assert s2["Bug"] == [("P-1", None), ("P-2", 7)]
    assert s2["Tache"] == [("P-3", None)]
    assert s2["Sous_tache_subtask"] == []  # deleted, not re-inserted (excluded type)

    sync_documents(spark, fetch, fam, field_map=FIELD_MAP, exclude_types=["Sous-tâche"])
    assert state(fam) == s2  # same batch twice: same result


def test_full_refresh_keeps_absent_types(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    seen = []
    b1 = [doc("P-1", "Bug", "2024-03-05T10:11:12.123+1100"), doc("P-2", "Story", "2024-03-05T10:11:12.123+1100")]
    b2 = [doc("P-3", "Bug", "2024-03-05T10:11:12.123+1100")]
    fetch = fetcher(spark, [b1, b2], seen)
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP, force_full=True)
    s = state(fam)
    assert s["Bug"] == [("P-3", None)] and s["Story"] == [("P-2", None)]
    assert fam.last_commit() == 2


def test_bucket_count_follows_size(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"), rows_per_bucket=300)
    fam.commit([fam.stage("small", spark.range(100).selectExpr("CAST(id AS STRING) AS jira")),
                fam.stage("big", spark.range(1000).selectExpr("CAST(id AS STRING) AS jira"))])
    assert fam.bucket_counts() == {"small": 1, "big": 4}
    assert fam.read("big").count() == 1000


def test_empty_family_means_full_refresh(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    assert fam.current() == {} and fam.read_all() == {}


def test_commit_is_all_or_nothing(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    staged = [fam.stage("a", spark.range(3).selectExpr("CAST(id AS STRING) AS jira")), fam.stage("b", spark.range(2).selectExpr("CAST(id AS STRING) AS jira"))]
    assert fam.current() == {}  # staged but not committed: invisible
    fam.commit(staged)
    assert fam.read("a").count() == 3 and fam.read("b").count() == 2


def test_upsert_rewrites_only_touched_buckets(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"), buckets=16)
    base = spark.range(2000).selectExpr("CAST(id AS STRING) AS jira", "'old' AS v")
    fam.commit([fam.stage("t", base)])
    before = fam.current()["t"]
    keys = spark.createDataFrame([("5",), ("77",)], "jira string")
    touched = fam.touched_buckets(keys, 16)
    assert fam.bucket_counts() == {"t": 16}
    ins = spark.createDataFrame([("5", "new"), ("77", "new")], "jira string, v string")
    fam.commit([fam.stage_upsert("t", keys, ins)])
    after = fam.current()["t"]
    assert len(set(before) - set(after)) == len(touched)  # only those folders replaced
    rows = {r["jira"]: r["v"] for r in fam.read("t").collect()}
    assert len(rows) == 2000 and rows["5"] == "new" and rows["77"] == "new" and rows["6"] == "old"


def test_copy_schema_isolates_failures(spark, sf_dir, tmp_root):
    sink = Sink(format="parquet", root=os.path.join(tmp_root, "out"))
    res = copy_schema(spark, TableSource(format="parquet", root=sf_dir), ["nation", "missing_table", "region"], sink, parallelism=2)
    rows = {r.table_name: r for r in res.collect()}
    assert rows["nation"].status == "ok" and rows["nation"].rows == 25
    assert rows["region"].status == "ok" and rows["region"].rows == 5
    assert rows["missing_table"].status == "failed" and rows["missing_table"].error


def test_strict_append_refuses_new_columns(spark, tmp_root):
    sink = Sink(format="parquet", root=os.path.join(tmp_root, "out"))
    write_table(spark.range(2), sink, "t")
    with pytest.raises(ValueError):
        write_table(spark.range(2).withColumn("extra", F.lit(1)), sink, "t", mode="append", evolve=False)
    write_table(spark.range(2).withColumn("extra", F.lit(1)), sink, "t", mode="append", evolve=True)
    assert read_written(spark, sink, "t").where(F.col("extra").isNull()).count() == 2


def test_repeated_keys_keep_latest(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    batch = [
        doc("P-1", "Bug", "2024-03-05T10:00:00.000+1100", x=1),
        doc("P-1", "Task", "2024-03-05T11:00:00.000+1100", x=2),
        doc("P-1", "Bug", "2024-03-05T09:00:00.000+1100", x=3),
        doc("P-2", "Bug", "2024-03-05T09:00:00.000+1100", x=4),
    ]
    sync_documents(spark, fetcher(spark, [batch], []), fam, field_map=FIELD_MAP, dedupe_keys=True)
    assert state(fam) == {"Bug": [("P-2", 4)], "Task": [("P-1", 2)]}


def test_versioned_copy_never_exposes_a_missing_table(spark, sf_dir, tmp_root):
    sink = Sink(format="parquet", root=os.path.join(tmp_root, "vout"), versioned=True)
    src = TableSource(format="parquet", root=sf_dir)
    res = copy_schema(spark, src, ["nation", "region"], sink, parallelism=2)
    assert {r.table_name: r.rows for r in res.collect()} == {"nation": 25, "region": 5}
    fam = TableFamily(spark, sink.root)
    first = fam.current()
    copy_schema(spark, src, ["nation"], sink)  # overwrite: a new version
    second = fam.current()
    assert len(second["nation"]) == 1
    assert second["region"] == first["region"] and second["nation"] != first["nation"]
    assert read_written(spark, sink, "nation").count() == 25
    write_table(spark.read.parquet(f"{sf_dir}/nation.parquet"), sink, "nation", mode="append")
    assert read_written(spark, sink, "nation").count() == 50


def test_append_refuses_type_change(spark, tmp_root):
    sink = Sink(format="parquet", root=os.path.join(tmp_root, "out"))
    write_table(spark.range(2), sink, "t")
    with pytest.raises(ValueError):
        write_table(spark.range(2).select(F.col("id").cast("string").alias("id")), sink, "t", mode="append", evolve=True)


def test_changed_field_shape_becomes_text(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    b1 = [doc("P-1", "Bug", "2024-03-05T10:00:00.000+1100", m="plain"), doc("P-2", "Bug", "2024-03-05T10:00:00.000+1100", m="old")]
    b2 = [doc("P-2", "Bug", "2024-03-05T11:00:00.000+1100", m={"a": 1})]
    fetch = fetcher(spark, [b1, b2], [])
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    rows = sorted((r["jira"], r["m"]) for r in fam.read("Bug").collect())
    assert rows == [("P-1", "plain"), ("P-2", '{"a":1}')]


def test_logged_mark_equals_scanned_mark(spark, tmp_root):
    from tablesync.operators import watermark

    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    b1 = [doc("P-1", "Bug", "2024-03-05T10:11:12.123+1100"), doc("P-2", "Story", "2024-03-06T08:00:00.500+1100")]
    sync_documents(spark, fetcher(spark, [b1], []), fam, field_map=FIELD_MAP)
    logged = fam.mark().first()["last_update"]
    scanned = watermark.high_water_mark(list(fam.read_all().values())).first()["last_update"]
    assert logged == scanned
    assert str(logged) == "2024-03-05 21:00:00.500000"


def test_compaction_keeps_state(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"), mark_column="u")
    fam.compact_every = 3
    base = spark.range(10).selectExpr("CAST(id AS STRING) AS jira", "'v0' AS v", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS u")
    fam.commit([fam.stage("t", base)])
    for i in range(1, 6):
        keys = spark.createDataFrame([(str(i),)], "jira string")
        ins = spark.createDataFrame([(str(i), f"v{i}")], "jira string, v string").selectExpr("*", f"TIMESTAMP_NTZ'2024-01-0{i + 1} 00:00:00' AS u")
        fam.commit([fam.stage_upsert("t", keys, ins)])
    fam.commit([fam.stage_add("t", spark.createDataFrame([("x", "add")], "jira string, v string"))])
    assert fam.last_commit() == 7
    rows = {r["jira"]: r["v"] for r in fam.read("t").collect()}
    assert len(rows) == 11 and rows["5"] == "v5" and rows["0"] == "v0" and rows["x"] == "add"
    assert str(fam.mark().first()["last_update"]) == "2024-01-06 00:00:00"


def test_add_then_upsert_in_other_bucket(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"), buckets=8)
    fam.commit([fam.stage("t", spark.range(100).selectExpr("CAST(id AS STRING) AS jira", "'old' AS v"))])
    fam.commit([fam.stage_add("t", spark.range(100, 200).selectExpr("CAST(id AS STRING) AS jira", "'added' AS v"))])
    keys = spark.range(100, 200).selectExpr("CAST(id AS STRING) AS jira")
    fam.commit([fam.stage_upsert("t", keys, None)])  # delete every added row, whatever its bucket
    rows = fam.read("t").collect()
    assert len(rows) == 100 and {r["v"] for r in rows} == {"old"}


def test_new_nested_field_keeps_types_and_buckets(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"), buckets=8)
    b1 = [doc(f"P-{i}", "Bug", "2024-03-05T10:00:00.000+1100", status={"name": "open"}) for i in range(40)]
    b2 = [doc("P-1", "Bug", "2024-03-05T11:00:00.000+1100", status={"name": "done", "category": "closed"})]
    fetch = fetcher(spark, [b1, b2], [])
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    before = set(fam.current()["Bug"])
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    after = set(fam.current()["Bug"])
    assert len(before - after) == 1  # one bucket rewritten, the rest kept
    df = fam.read("Bug")
    assert dict(df.dtypes)["status"] == "struct<name:string,category:string>"
    rows = {r["jira"]: r["status"] for r in df.collect()}
    assert rows["P-1"]["category"] == "closed" and rows["P-2"]["name"] == "open" and rows["P-2"]["category"] is None


def test_vacuum_keeps_live_versions(spark, tmp_root):
    from tablesync.session import list_dirs

    fam = TableFamily(spark, os.path.join(tmp_root, "targets"), buckets=4)
    b1 = [doc(f"P-{i}", "Bug", "2024-03-05T10:00:00.000+1100", x=i) for i in range(20)]
    b2 = [doc("P-1", "Bug", "2024-03-05T11:00:00.000+1100", x=100)]
    fetch = fetcher(spark, [b1, b2], [])
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    before = {r["jira"]: r["x"] for r in fam.read("Bug").collect()}
    deleted = fam.vacuum(retain_commits=0, min_age_hours=0)
    after = {r["jira"]: r["x"] for r in fam.read("Bug").collect()}
    assert after == before and after["P-1"] == 100 and len(after) == 20
    # the first version still holds three untouched buckets, so it stays
    assert len(list_dirs(spark, os.path.join(fam.root, "Bug"))) == 2 and deleted == []
    fam.commit([fam.stage("Bug", fam.read("Bug"))])  # a full rewrite frees both
    assert len(fam.vacuum(retain_commits=0, min_age_hours=0)) == 2
    assert fam.read("Bug").count() == 20


def test_empty_incremental_batch_changes_nothing(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    b1 = [doc("P-1", "Bug", "2024-03-05T10:00:00.000+1100", x=1)]
    fetch = fetcher(spark, [b1, []], [])
    sync_documents(spark, fetch, fam, field_map=FIELD_MAP)
    before, commits = fam.current(), fam.last_commit()
    empty_fetch = lambda _since: spark.createDataFrame([], "raw string")
    res = sync_documents(spark, empty_fetch, fam, field_map=FIELD_MAP)
    assert res.count() == 0 and fam.current() == before and fam.last_commit() == commits


def test_latest_per_key_keeps_keyless_documents(spark):
    from tablesync.operators import documents, routing
    from tablesync.plans.jobs import latest_per_key

    objs = [
        {"fields": {"issuetype": {"name": "Bug"}, "updated": "2024-03-05T10:00:00.000+1100", "n": 1}},
        {"fields": {"issuetype": {"name": "Bug"}, "updated": "2024-03-05T10:00:00.000+1100", "n": 1}},
        {"key": "A", "fields": {"updated": "2024-03-05T10:00:00.000+1100", "n": 2}},
        {"key": "A", "fields": {"updated": "2024-03-05T12:00:00.000+1100", "n": 3}},
    ]
    raw = spark.createDataFrame([(json.dumps(o),) for o in objs], "raw string")
    out = latest_per_key(routing.with_type(documents.parse(raw).select("doc")))
    ns = sorted(r[0] for r in out.select(F.try_variant_get("doc", "$.fields.n", "int")).collect())
    assert ns == [1, 1, 3]  # both keyless documents kept, the newest "A"
