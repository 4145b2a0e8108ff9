import pytest

from tablesync.sources import catalog as cat


def test_text_no_filter_is_plain():
    for empty in (None, "", []):
        assert cat.catalog_sql("test", exclude=empty, only=empty) == (
            "SELECT table_name FROM information_schema.tables where table_schema = 'test'"
        )


def test_text_exclude():
    q = cat.catalog_sql("test", exclude=["a", "b"])
    assert q.endswith("and table_name not in ('a', 'b')")


def test_only_wins_over_exclude():
    q = cat.catalog_sql("test", exclude=["a"], only=["c"])
    assert "not in" not in q and q.endswith("and table_name in ('c')")


def test_literals_escaped():
    assert "table_schema = 'O''Neil'" in cat.catalog_sql("O'Neil")


def test_oracle_dialect():
    assert cat.catalog_sql("HR", exclude="'X','Y'", dialect="oracle") == (
        "SELECT table_name FROM all_tables where owner = 'HR' and table_name not in ('X', 'Y')"
    )


def test_unknown_dialect():
    with pytest.raises(ValueError):
        cat.catalog_sql("x", dialect="db2")


def test_filter_catalog_frame(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c"), ("t", "a")], "table_schema string, table_name string")
    names = lambda d: sorted(r[0] for r in d.collect())
    assert names(cat.filter_catalog(df, "s")) == ["a", "b", "c"]
    assert names(cat.filter_catalog(df, "s", exclude=["a", "b"])) == ["c"]
    assert names(cat.filter_catalog(df, "s", exclude=["a"], only=["a"])) == ["a"]


def test_folder_catalog(spark, sf_dir):
    rows = cat.folder_catalog(spark, sf_dir).collect()
    assert {r.table_name for r in rows} >= {"orders", "lineitem", "nation"}
    assert all(r.bytes > 0 and r.files >= 1 for r in rows)


def test_preview_limit(spark, sf_dir):
    assert cat.preview(cat.folder_catalog(spark, sf_dir), 5).count() == 5
