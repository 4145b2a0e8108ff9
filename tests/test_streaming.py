import json
import os

from tablesync.plans.sinks import TableFamily
from tablesync.streaming.incremental import start_sync


def _doc(key, typ, updated, **extra):
    return {"key": key, "id": key, "fields": {"issuetype": {"name": typ}, "updated": updated, **extra}, "changelog": {}}


def _land(folder, name, docs):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        for d in docs:
            fh.write(json.dumps(d) + "\n")


def test_stream_full_then_incremental(spark, tmp_root):
    landing = os.path.join(tmp_root, "landing")
    os.makedirs(landing)
    fam = TableFamily(spark, os.path.join(tmp_root, "targets"))
    ckpt = os.path.join(tmp_root, "ckpt")
    kw = dict(field_map={"updated": "Mise_a_jour"})
    _land(landing, "a.jsonl", [_doc("K-1", "Bug", "2024-01-01T10:00:00.000+1100"), _doc("K-2", "Task", "2024-01-01T10:00:00.000+1100")])
    start_sync(spark, landing, fam, checkpoint=ckpt, **kw).awaitTermination(300)
    assert {t: df.count() for t, df in fam.read_all().items()} == {"Bug": 1, "Task": 1}

    _land(landing, "b.jsonl", [_doc("K-2", "Bug", "2024-01-02T10:00:00.000+1100", sev=3)])
    start_sync(spark, landing, fam, checkpoint=ckpt, **kw).awaitTermination(300)
    state = {t: sorted(r["jira"] for r in df.collect()) for t, df in fam.read_all().items()}
    assert state == {"Bug": ["K-1", "K-2"], "Task": []}
    assert fam.read("Bug").where("jira = 'K-2'").first()["sev"] == 3


def test_landed_files_are_compressed_and_bounded(spark, sf_dir, monkeypatch):
    import os

    from tablesync.plans import registry
    from tablesync.session import scratch_path

    paths = {}

    def kept(spark, purpose):
        paths[purpose] = scratch_path(spark, purpose)
        return paths[purpose]

    monkeypatch.setattr(registry, "scratch_path", kept)
    monkeypatch.setattr(registry, "LANDED_DOCUMENTS", 400)
    rows = registry.stream_sync(spark, sf_dir).count()
    orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).count()
    assert rows == orders > 400
    files = [f for f in os.listdir(paths["landing"]) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert all(spark.read.text(os.path.join(paths["landing"], f)).count() <= 400 for f in files)
