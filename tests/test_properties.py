"""Properties from the test plan: kept + deleted = before; an upsert after a
full refresh equals a full refresh of the latest state; empty targets mean
a full refresh."""

import json
import os
import random

from pyspark.sql import functions as F

from tablesync.operators import upsert
from tablesync.plans.jobs import sync_documents
from tablesync.plans.sinks import TableFamily


def test_kept_plus_deleted_is_before(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for q in (10, 30, 49):
        keys = li.where(F.col("l_quantity") > q).select(F.col("l_orderkey").alias("o_orderkey"))
        kept = upsert.delete_by_keys(o, keys, "o_orderkey").count()
        deleted = upsert.deleted_count(o, keys, "o_orderkey").first()["n"]
        assert kept + deleted == o.count()


def _doc(key, typ, minute, x):
    return {"key": key, "id": key, "fields": {"issuetype": {"name": typ}, "updated": f"2024-03-05T10:{minute:02d}:00.000+1100", "x": x}, "changelog": {}}


def _state(fam):
    return {t: sorted((r["jira"], r["x"]) for r in df.collect()) for t, df in fam.read_all().items()}


def test_incremental_equals_full_refresh_of_latest(spark, tmp_root):
    rnd = random.Random(11)
    for trial in range(2):
        b1 = [_doc(f"K-{i}", rnd.choice("ABC"), rnd.randint(0, 30), rnd.randint(0, 9)) for i in range(60)]
        b2 = [_doc(f"K-{i}", rnd.choice("ABCD"), rnd.randint(31, 59), rnd.randint(10, 19)) for i in rnd.sample(range(80), 25)]
        latest = {d["key"]: d for d in b1}
        latest.update({d["key"]: d for d in b2})
        to_df = lambda docs: spark.createDataFrame([(json.dumps(d),) for d in docs], "raw string")
        inc = TableFamily(spark, os.path.join(tmp_root, f"inc{trial}"), buckets=4)
        batches = iter([to_df(b1), to_df(b2)])
        sync_documents(spark, lambda _s: next(batches), inc, field_map={"updated": "Mise_a_jour"})
        sync_documents(spark, lambda _s: next(batches), inc, field_map={"updated": "Mise_a_jour"})
        full = TableFamily(spark, os.path.join(tmp_root, f"full{trial}"), buckets=4)
        sync_documents(spark, lambda _s: to_df(list(latest.values())), full, field_map={"updated": "Mise_a_jour"})
        a, b = _state(inc), _state(full)
        assert {t: v for t, v in a.items() if v} == {t: v for t, v in b.items() if v}


def test_empty_targets_mean_full_refresh(spark, tmp_root):
    fam = TableFamily(spark, os.path.join(tmp_root, "t"))
    empty = spark.createDataFrame([], "jira string, Mise_a_jour string")
    fam.commit([fam.stage("Bug", empty)])
    seen = []

    def fetch(since):
        seen.append(since)
        return spark.createDataFrame([(json.dumps(_doc("K-1", "Bug", 5, 1)),)], "raw string")

    sync_documents(spark, fetch, fam, field_map={"updated": "Mise_a_jour"})
    assert seen == [None]
