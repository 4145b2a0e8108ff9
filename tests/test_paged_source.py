import os

import pyarrow as pa
import pyarrow.parquet as pq

from tablesync.sources import documents as paged


def _orders_file(root, n):
    path = os.path.join(root, f"orders_{n}.parquet")
    tbl = pa.table(
        {
            "o_orderkey": pa.array(range(n), pa.int64()),
            "o_orderstatus": pa.array(["F"] * n),
            "o_orderpriority": pa.array(["1-URGENT"] * n),
            "o_totalprice": pa.array([1.5] * n),
            "o_custkey": pa.array([7] * n, pa.int64()),
        }
    )
    pq.write_table(tbl, path, row_group_size=37)
    return path


def _read(spark, path, **opts):
    from tablesync.sources.standins import parquet_orders_fetcher

    paged.register(spark, parquet_orders_fetcher)
    r = spark.read.format("paged_documents").option("path", path)
    for k, v in opts.items():
        r = r.option(k, str(v))
    return r.load()


def test_edge_page_counts(spark, tmp_root):
    for n in (0, 100, 101, 250):
        df = _read(spark, _orders_file(tmp_root, n), pages_per_partition=2)
        rows = df.collect()
        assert len(rows) == n
        assert sorted(r.page for r in rows) == sorted(i // 100 for i in range(n))
        expected_parts = max(1, -(-(-(-n // 100)) // 2))
        assert df.rdd.getNumPartitions() == expected_parts


def test_fields_resource(spark, sf_dir):
    df = _read(spark, os.path.join(sf_dir, "orders.parquet"), resource="fields")
    assert ("updated", "Mise à jour") in [tuple(r) for r in df.collect()]


def test_row_group_aligned_plan(spark, tmp_root):
    # 250 rows in groups of 37: default plan comes from the fetcher
    path = _orders_file(tmp_root, 250)
    df = _read(spark, path)
    rows = df.collect()
    assert len(rows) == 250 and len({r.raw for r in rows}) == 250
    from tablesync.sources.standins import ParquetOrdersFetcher

    plan = ParquetOrdersFetcher({"path": path}).plan_pages(3, 100, max_docs_per_task=100)
    covered = [p for a, b in plan for p in range(a, b + 1)]
    assert covered == [0, 1, 2]


class _TypesFetcher:
    def __init__(self, options):
        self.options = options

    def types(self):
        return [("Tâche", False), ("Sous-tâche", True)]


def _types_fetcher(options):
    return _TypesFetcher(options)


def test_types_resource_feeds_routing(spark):
    import json
    import sys

    from pyspark import cloudpickle

    from tablesync.operators import documents, routing

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    paged.register(spark, _types_fetcher)
    types = spark.read.format("paged_documents").option("resource", "types").load()
    assert sorted(tuple(r) for r in types.collect()) == [("Sous-tâche", True), ("Tâche", False)]
    docs = spark.createDataFrame(
        [(json.dumps({"key": "K-1", "fields": {"issuetype": {"name": "Sous-tâche"}}}),)], "raw string"
    )
    routed = routing.route(documents.parse(docs), types=types)
    assert routed.select("_target").first()[0] == "Sous_tache_subtask"


class _ListFetcher:
    """Serves ``served`` documents, ``short`` at most a page, and announces ``announced``."""

    def __init__(self, options):
        self.options = {k: int(v) for k, v in options.items() if k in ("announced", "served", "short")}

    def total(self, query, since):
        return self.options["announced"]

    def page(self, query, start_at, max_results, since):
        end = min(start_at + min(max_results, self.options["short"]), self.options["served"])
        return [{"key": f"K-{i}"} for i in range(start_at, end)]


def _list_fetcher(options):
    return _ListFetcher(options)


def test_reads_to_the_real_end(spark):
    import json
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    paged.register(spark, _list_fetcher)
    for announced, served, short in ((250, 330, 100), (250, 250, 60), (0, 5, 100), (330, 250, 100)):
        df = spark.read.format("paged_documents").options(announced=announced, served=served, short=short, pages_per_partition=1).load()
        keys = [json.loads(r.raw)["key"] for r in df.collect()]
        assert len(keys) == len(set(keys)) == served
