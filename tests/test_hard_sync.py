"""Rows in equal rows written plus rejects, whatever the documents look like."""

import json
import os

from tablesync.plans.jobs import sync_documents
from tablesync.plans.sinks import TableFamily
from tablesync.streaming.incremental import start_sync

OLD, NEW = "2024-01-01T10:00:00.000+1100", "2024-01-02T10:00:00.000+1100"


def doc(key, typ, updated=OLD, **extra):
    issue = None if typ is None else {"name": typ} if not isinstance(typ, tuple) else {"name": typ[0], "subtask": typ[1]}
    return json.dumps({"key": key, "fields": {"issuetype": issue, "updated": updated, **extra}})


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw string")


def state(family):
    found = {t: sorted(r.jira for r in df.collect()) for t, df in family.read_all().items()}
    return {t: keys for t, keys in found.items() if keys}


def rejects(spark, family):
    return {(r.reason, r.jira) for r in spark.read.parquet(family.rejects).collect()}


def test_nothing_is_lost_or_doubled(spark, tmp_root):
    family = TableFamily(spark, os.path.join(tmp_root, "t"))
    types = spark.createDataFrame([("Task", False), ("Task", True), ("Bug", False)], "name string, subtask boolean")
    texts = [
        doc("A-1", ("Task", False)), doc("A-2", ("Task", True)), doc("A-3", "Task"),
        doc("A-4", "Bug", Name=1), doc("A-5", "bug", name=2),
        doc("A-6", None), doc("A-7", ""), "{broken",
        doc("A-8", "Bug", OLD), doc("A-8", "Bug", NEW),
    ]
    result = sync_documents(spark, lambda _s: frame(spark, texts), family, types=types).collect()
    assert state(family) == {"Bug": ["A-4", "A-5", "A-8"], "Task": ["A-1"], "Task_subtask": ["A-2"]}
    assert rejects(spark, family) == {
        ("no type", "A-6"), ("no type", "A-7"), ("not a JSON document", None), ("task or sub-task", "A-3")
    }
    assert {r.rejected for r in result} == {4}
    assert sum(map(len, state(family).values())) + 4 == len(texts) - 1  # one key came twice


def test_rejected_keys_delete_nothing(spark, tmp_root):
    family = TableFamily(spark, os.path.join(tmp_root, "t"))
    sync_documents(spark, lambda _s: frame(spark, [doc("A-1", "Bug")]), family)
    sync_documents(spark, lambda _s: frame(spark, [doc("A-1", None, NEW), doc("A-2", "Bug", NEW)]), family, upsert_only=True)
    assert state(family) == {"Bug": ["A-1", "A-2"]}


def test_default_stream_adds_and_ignores_late_versions(spark, tmp_root):
    landing = os.path.join(tmp_root, "landing")
    os.makedirs(landing)
    family = TableFamily(spark, os.path.join(tmp_root, "t"))
    batches = [[doc("A-1", "Bug", NEW, v=2)], [doc("A-2", "Bug")], [doc("A-1", "Task", OLD, v=1), doc("A-3", "Bug")]]
    for k, texts in enumerate(batches):
        with open(os.path.join(landing, f"{k}.jsonl"), "w", encoding="utf-8") as out:
            out.write("\n".join(texts) + "\n")
        query = start_sync(spark, landing, family, checkpoint=os.path.join(tmp_root, "c"))
        query.awaitTermination(300)
        assert query.exception() is None
    assert state(family) == {"Bug": ["A-1", "A-2", "A-3"]}
    assert family.read("Bug").where("jira = 'A-1'").first().v == 2


def test_types_named_like_the_family_s_own_folders(spark, tmp_root):
    family = TableFamily(spark, os.path.join(tmp_root, "r"))
    for mark in (OLD, NEW):
        texts = [doc("A-1", "-commits", mark), doc("A-2", "-rejects", mark), doc("A-3", ".family", mark), doc("A-4", None, mark)]
        sync_documents(spark, lambda _s: frame(spark, texts), family)
        assert state(family) == {"_commits": ["A-1"], "_rejects": ["A-2"], "_family": ["A-3"]}
    assert rejects(spark, family) == {("no type", "A-4")}


def test_late_versions_lose_without_a_shuffle_of_the_stored_rows(spark, tmp_root):
    from tablesync.plans.jobs import late_keys

    family = TableFamily(spark, os.path.join(tmp_root, "l"), buckets=4)
    sync_documents(spark, lambda _s: frame(spark, [doc(f"A-{i}", "Bug" if i % 2 else "Task", NEW) for i in range(40)]), family)
    batch = spark.createDataFrame([("A-1", "2024-01-01 00:00:00"), ("A-2", "2025-01-01 00:00:00"), ("A-4", "2024-01-01 00:00:00"), ("B-1", None)], "jira string, t string")
    batch = batch.selectExpr("jira", "cast(t as timestamp_ntz) AS _own")
    late = late_keys(family, batch, "updated", 4)
    assert sorted(r.jira for r in late.collect()) == ["A-1", "A-4"]
    plan = late._jdf.queryExecution().executedPlan().toString()
    stored_side = [line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and stored_side
    # in the other form the same keys are late
    assert sorted(r.jira for r in late_keys(family, batch, "updated", 10**9).collect()) == ["A-1", "A-4"]


def test_a_stream_of_batches_with_a_late_older_version(spark, tmp_root):
    landing, family = os.path.join(tmp_root, "land"), TableFamily(spark, os.path.join(tmp_root, "s"))
    os.makedirs(landing)
    batches = [[doc("A-1", "Bug", NEW, v=2), doc("A-2", "Bug", OLD, v=1)], [doc("A-1", "Task", OLD, v=1), doc("A-2", "Task", NEW, v=2)], [doc("A-3", "Bug", OLD, v=1)]]
    for k, texts in enumerate(batches):
        with open(os.path.join(landing, f"{k}.jsonl"), "w") as fh:
            fh.write("\n".join(texts) + "\n")
        query = start_sync(spark, landing, family, checkpoint=os.path.join(tmp_root, "c"))
        query.awaitTermination(300)
        assert query.exception() is None
    assert state(family) == {"Bug": ["A-1", "A-3"], "Task": ["A-2"]}
    assert {r.jira: r.v for df in family.read_all().values() for r in df.collect()} == {"A-1": 2, "A-2": 2, "A-3": 1}
