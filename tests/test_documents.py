import json

from pyspark.sql import functions as F

from tablesync.operators import documents


def _docs(spark, objs):
    return documents.parse(spark.createDataFrame([(json.dumps(o),) for o in objs], "raw string"))


def _flat(spark, objs, **kw):
    d = _docs(spark, objs)
    ft, ct = documents.infer_schemas(d, by=None)[""]
    return documents.flatten(d, ft, ct, **kw)


def test_envelope_precedence(spark):
    doc = {"key": "K-1", "id": "1", "fields": {"id": "from-fields", "a": 1, "changelog": "x"}, "changelog": {"histories": []}}
    df = _flat(spark, [doc])
    assert df.columns == ["jira", "id", "a", "changelog"]
    r = df.first()
    assert r["id"] == "from-fields" and r["jira"] == "K-1"
    assert r["changelog"] is not None and r["changelog"]["histories"] == []


def test_empty_structs(spark):
    objs = [
        {"key": "1", "fields": {"a": 1, "e": {}}},
        {"key": "2", "fields": {"a": {"b": {}}}},
        {"key": "3", "fields": {"l": [{}]}},
        {"key": "4", "fields": {"e": {"x": None}}},
        {"key": "5", "fields": {"l": []}},
        {"key": "6", "fields": {"l": [{"z": {}}]}},
    ]
    for o in objs:
        o["changelog"] = {"histories": []}
    rows = {r["jira"]: r for r in _flat(spark, objs).collect()}
    assert rows["1"]["e"] is None
    assert rows["4"]["e"] is not None and rows["4"]["e"]["x"] is None
    assert rows["5"]["l"] == []


def test_empty_struct_nested(spark):
    objs = [{"key": "2", "fields": {"a": {"b": {}}}, "changelog": {}}]
    r = _flat(spark, objs).first()
    assert r["a"] is not None and r["a"]["b"] is None  # parent kept, child nulled
    assert r["changelog"] is None


def test_empty_struct_in_list_kept(spark):
    objs = [{"key": "3", "fields": {"l": [{}], "m": [{"z": {}, "w": 1}]}, "changelog": {"h": 1}}]
    r = _flat(spark, objs).first()
    assert r["l"] == ["{}"]
    assert r["m"][0]["z"] is None and r["m"][0]["w"] == 1


def test_deep_dates(spark):
    d = "2024-03-05T10:11:12.123+1100"
    objs = [{"key": "K", "fields": {"updated": d, "s": {"at": d, "n": 5}, "l": [d, "x"], "ll": [{"at": d}]}, "changelog": {"histories": [{"created": d}]}}]
    r = _flat(spark, objs).first()
    want = "2024-03-04 23:11:12.123000"
    assert r["updated"] == want and r["s"]["at"] == want and r["l"] == [want, "x"]
    assert r["ll"][0]["at"] == want and r["changelog"]["histories"][0]["created"] == want


def test_mixed_shapes_become_json_text(spark):
    objs = [{"key": "1", "fields": {"m": 1}, "changelog": {}}, {"key": "2", "fields": {"m": {"a": 1}}, "changelog": {}}]
    rows = sorted((r["jira"], r["m"]) for r in _flat(spark, objs).collect())
    assert rows == [("1", "1"), ("2", '{"a":1}')]


def test_rename_and_collisions(spark):
    objs = [{"key": "1", "fields": {"customfield_1": 1, "Cout": 2, "cf2": 3}, "changelog": {}}]
    df = _flat(spark, objs, field_map={"customfield_1": "Cout"})
    assert df.columns == ["jira", "id", "Cout", "cf2", "changelog"]
    # VARIANT keeps keys sorted, so "last" is the last in sorted key order
    # (Cout < cf2 < customfield_1): the renamed customfield_1 wins.
    assert df.first()["Cout"] == 1
    df2 = _flat(spark, objs, field_map={"customfield_1": "Cout"}, on_collision="suffix")
    assert df2.columns == ["jira", "id", "Cout", "cf2", "Cout_2", "changelog"]
    import pytest

    with pytest.raises(ValueError):
        _flat(spark, objs, field_map={"customfield_1": "cout"}, on_collision="error")


def test_exclude_after_rename_protects_key(spark):
    objs = [{"key": "1", "fields": {"customfield_1": 1, "b": 2}, "changelog": {}}]
    df = _flat(spark, objs, field_map={"customfield_1": "Prix"}, exclude_fields=["Prix", "jira", "changelog"])
    assert df.columns == ["jira", "id", "b"]


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Coût` int, `Cout` int")
    out = documents.clean_columns(df)
    assert out.columns == ["Cout"] and out.first()[0] == 2


def test_deep_to_utc_typed(spark):
    d = "2024-03-05T10:11:12.123+1100"
    df = spark.createDataFrame([({"a": d}, [d], {"k": d}, None)], "s struct<a:string>, l array<string>, m map<string,string>, n struct<a:string>")
    r = documents.deep_to_utc(df).first()
    want = "2024-03-04 23:11:12.123000"
    assert r["s"]["a"] == want and r["l"] == [want] and r["m"] == {"k": want} and r["n"] is None


def test_value_text(spark):
    from pyspark.sql import types as T

    from tablesync.functions.text import value_text

    df = spark.createDataFrame([([[1, None], [2]], True, [])], "a array<array<int>>, b boolean, e array<int>")
    r = df.select(
        value_text(F.col("a"), T.ArrayType(T.ArrayType(T.IntegerType()))),
        value_text(F.col("b"), T.BooleanType()),
        value_text(F.col("e"), T.ArrayType(T.IntegerType())),
    ).first()
    assert tuple(r) == ("1, None, 2", "True", "")


def test_python_float_text(spark):
    import random
    import struct

    from tablesync.functions.text import python_float_text

    fixed = [0.0, -0.0, 1.0, 1e7, 12345678.9, 1e16, 1.5e16, 1e-3, 1e-4, 1.5e-5, 123.456, 1e23, 5e-324,
             1.7976931348623157e308, 0.1 + 0.2, float("nan"), float("inf"), float("-inf"), -1e-7, 1e15, 2.5]
    rnd = random.Random(5)
    sample = [struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0] for _ in range(100_000)]
    sample += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-20, 25) for _ in range(20_000)]
    sample += [round(rnd.uniform(-1, 1) * 10 ** rnd.randint(-5, 9), rnd.randint(0, 9)) for _ in range(20_000)]
    sample += [struct.unpack("d", struct.pack("Q", rnd.getrandbits(52)))[0] for _ in range(5_000)]  # subnormal
    vals = fixed + sample
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    got = {r.i: r.t for r in df.select("i", python_float_text(F.col("x")).alias("t")).collect()}
    assert [got[i] for i in range(len(fixed))] == [str(v) for v in fixed]
    assert [got[i] for i in range(len(fixed), len(vals))] == [str(v) for v in vals[len(fixed) :]]


def test_value_text_of_nested_floats(spark):
    from pyspark.sql import types as T

    from tablesync.functions.text import value_text

    rows = [([[0.1 + 0.2, None], None, []], 2.0), (None, None), ([[1e16, float("nan")]], 5e-324)]
    df = spark.createDataFrame(rows, "a array<array<double>>, x double")
    got = df.select(value_text(F.col("a"), df.schema["a"].dataType), value_text(F.col("x"), T.DoubleType())).collect()
    assert [tuple(r) for r in got] == [("0.30000000000000004, None, None, ", "2.0"), ("None", "None"), ("1e+16, nan", "5e-324")]


def test_typing_reads_paths_not_documents(spark, tmp_root):
    """No value between the document and a leaf is built: the scan gets the paths."""
    from tablesync.operators import documents

    texts = ['{"key":"A","fields":{"s":{"name":"x"},"u":"2024-03-05T10:00:00.000+1100","n":1}}', '{"key":"B","fields":{"s":{}}}', "7"]
    raw = spark.createDataFrame([(t,) for t in texts], "raw string")
    docs, ft, ct = documents.stage(documents.parse(raw))
    flat = documents.flatten(docs, ft, ct)
    plan = flat._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema") :]
    assert "fields" not in plan[: plan.index("FileScan")].split("Project", 1)[1] and "doc:variant" not in scan
    rows = sorted((r.jira, r.n, r.s and r.s.name, r.u) for r in flat.where("jira IS NOT NULL").collect())
    assert rows == [("A", 1, "x", "2024-03-04 23:00:00.000000"), ("B", None, None, None)]


def test_latest_documents_are_parsed_once(spark, sf_dir):
    from tablesync.plans import registry

    plan = registry.dedupe_latest(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "Aggregate" not in plan
