import os

from tablesync.__main__ import main


def test_copy_folder_cli(spark, sf_dir, tmp_root):
    out = os.path.join(tmp_root, "out")
    schema = os.path.basename(sf_dir)
    rc = main(["copy-folder", "--source-root", sf_dir, "--schema", schema, "--sink-root", out, "--only", "'nation','region'"])
    assert rc == 0
    assert spark.read.parquet(os.path.join(out, "nation")).count() == 25
    assert spark.read.parquet(os.path.join(out, "region")).count() == 5
    assert not os.path.exists(os.path.join(out, "orders"))


def test_connector_options():
    from tablesync.plans.sinks import Sink, connector_options

    assert connector_options(Sink(format="x", dataset="d", bucket="b"), evolve=True) == {"temporaryGcsBucket": "b"}
    assert connector_options(Sink(format="x", dataset="d"), evolve=False) == {"writeMethod": "direct"}
    assert connector_options(Sink(format="x", dataset="d"), evolve=True) == {
        "writeMethod": "direct", "allowFieldAddition": "true", "allowFieldRelaxation": "true",
    }
    assert connector_options(Sink(root="/r", options={"compression": "zstd"}), evolve=True) == {"compression": "zstd"}
    assert Sink(format="x", dataset="d").target("t") == "d.t"


def test_quoted_names():
    from tablesync.sources.relational import TableSource, bounds_sql, size_sql

    source = TableSource(schema="Sales", url="jdbc:postgresql://h/d")
    assert source.qualified('Order"s') == '"Sales"."Order""s"'
    assert bounds_sql(source.qualified("Orders"), "id") == '(SELECT MIN(id) AS lo, MAX(id) AS hi, COUNT(*) AS n FROM "Sales"."Orders") b'
    assert "pg_total_relation_size('\"Sales\".\"Orders\"')" in size_sql(source.qualified("Orders"))
