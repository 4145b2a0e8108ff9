import decimal


from tablesync.functions.sizing import partitions_for
from tablesync.operators import coerce
from tablesync.sources.relational import hash_predicates, range_predicates


def _wide(spark):
    schema = (
        "id bigint, amount decimal(18,2), big decimal(38,9), label string, created timestamp, blob binary, "
        "tags array<int>, attrs map<string,int>, amounts array<decimal(4,1)>"
    )
    row = (1, decimal.Decimal("16777217.25"), decimal.Decimal("1.5"), "  x ", None, bytearray(b"\x00"), [1], {"a": 1}, [decimal.Decimal("1.5")])
    return spark.createDataFrame([row, (2, None, None, "", None, None, None, None, None)], schema)


def test_decimal_to_float(spark):
    df = coerce.decimals_to(_wide(spark))
    types = dict(df.dtypes)
    assert types["amount"] == "float" and types["big"] == "float"
    assert types["amounts"] == "array<decimal(4,1)>"  # nested decimals untouched
    assert df.first()["amount"] == 16777218.0


def test_decimal_to_double_and_keep(spark):
    assert coerce.decimals_to(_wide(spark), "double").first()["amount"] == 16777217.25
    assert dict(coerce.decimals_to(_wide(spark), "keep").dtypes)["amount"] == "decimal(18,2)"


def test_drop_types(spark):
    df = coerce.drop_types(_wide(spark))
    assert df.columns == ["id", "amount", "big", "label", "created"]


def test_drop_types_pruned_from_scan(spark, sf_dir):
    from tablesync.plans.registry import _wide_part

    plan = coerce.drop_types(_wide_part(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "p_blob" not in plan and "p_tags" not in plan


def test_clean_strings(spark):
    rows = coerce.clean_strings(_wide(spark)).select("label").collect()
    assert [r[0] for r in rows] == ["x", None]


def test_partitions_for():
    assert [partitions_for(b) for b in (0, None, -5, 1, 9437184, 9437185, 94371840)] == [None, None, None, 1, 1, 2, 10]


def test_range_predicates_cover_and_split():
    preds = range_predicates("k", 0, 99, 4)
    assert len(preds) == 4
    assert preds[0] == "(k < 25) OR k IS NULL"
    assert preds[-1] == "k >= 75"
    assert range_predicates("k", 5, 5, 8) == ["1 = 1"]


def test_range_predicates_exhaustive_disjoint(spark):
    df = spark.range(-10, 130).selectExpr("CASE WHEN id = 7 THEN NULL ELSE id END AS k")
    preds = range_predicates("k", 0, 119, 6)
    for row in df.collect():
        k = row[0]
        hits = [p for p in preds if spark.sql(f"SELECT {p.replace('k', str(k) if k is not None else 'CAST(NULL AS BIGINT)')}").first()[0]]
        assert len(hits) == 1, (k, hits)


def test_hash_predicates():
    preds = hash_predicates("ORA_HASH(id)", 3)
    assert preds == ["(MOD(ORA_HASH(id), 3) = 0) OR (ORA_HASH(id)) IS NULL", "MOD(ORA_HASH(id), 3) = 1", "MOD(ORA_HASH(id), 3) = 2"]
