"""The document rules, as literal documents and the rows expected of them."""

import json

import pytest

from tablesync.operators import documents

AT = "2024-03-05T10:11:12.123+1100"
UTC = "2024-03-04 23:11:12.123000"


def rows(spark, objects, **kw):
    docs = documents.parse(spark.createDataFrame([(json.dumps(o),) for o in objects], "raw string"))
    ft, ct = documents.infer_schemas(docs, by=None)[""]
    return [r.asDict(recursive=True) for r in documents.flatten(docs, ft, ct, **kw).orderBy("jira").collect()]


def test_envelope_and_precedence(spark):
    a, b = rows(
        spark,
        [
            {"key": "A", "id": "1", "fields": {"summary": "s"}, "changelog": {"n": 1}},
            {"key": "C", "id": "3", "fields": {"jira": "override", "id": "9"}, "changelog": None},
        ],
    )
    assert a == {"jira": "A", "id": "1", "summary": "s", "changelog": {"n": 1}}
    assert b == {"jira": "override", "id": "9", "summary": None, "changelog": None}


def test_dates_at_any_depth(spark):
    (r,) = rows(
        spark,
        [{"key": "A", "fields": {"at": AT, "deep": {"list": [{"w": AT}, {"w": "no date"}]}, "not": "2024-13-05T10:11:12.123+1100"}}],
    )
    assert r["at"] == UTC
    assert r["deep"] == {"list": [{"w": UTC}, {"w": "no date"}]}
    assert r["not"] == "2024-13-05T10:11:12.123+1100"


def test_empty_objects(spark):
    a, b = rows(
        spark,
        [
            {"key": "A", "fields": {"e": {}, "n": {"x": None}, "m": [{"z": {}, "w": "v"}]}},
            {"key": "B", "fields": {"e": {"q": 1}, "n": {"x": "y"}}},
        ],
    )
    assert a["e"] is None and a["n"] == {"x": None} and a["m"][0]["w"] == "v" and a["m"][0]["z"] is None
    assert b["e"] == {"q": 1} and b["n"] == {"x": "y"}


def test_rename_then_exclude(spark):
    (r,) = rows(
        spark,
        [{"key": "A", "id": "1", "fields": {"updated": AT, "customfield_1": 2.5, "summary": "s"}}],
        field_map={"updated": "Mise_a_jour", "customfield_1": "Prix"},
        exclude_fields=["summary", "jira", "updated"],
    )
    assert r == {"jira": "A", "id": "1", "Mise_a_jour": UTC, "Prix": 2.5, "changelog": None}


def test_mixed_shapes_by_their_own_kind(spark):
    got = rows(spark, [{"key": k, "fields": {"f": v}} for k, v in (("A", {"x": 1}), ("B", AT), ("C", "plain"), ("D", {}), ("E", [1]))])
    assert [r["f"] for r in got] == ['{"x":1}', UTC, "plain", None, "[1]"]


def test_keys_differing_by_case_keep_every_value(spark):
    a, b, c = rows(
        spark,
        [
            {"key": "A", "fields": {"Name": 1, "n": {"Xa": 1}}},
            {"key": "B", "fields": {"name": 2, "n": {"xa": "t"}}},
            {"key": "C", "fields": {"Name": 3, "name": 4}},
        ],
    )
    assert [r["Name"] for r in (a, b, c)] == [1, 2, 4]
    assert a["n"] == {"Xa": "1"} and b["n"] == {"Xa": "t"}


@pytest.mark.parametrize("text", ["{", "", '{"a":1,"a":2}', "nonsense"])
def test_bad_text_is_no_failure(spark, text):
    raw = spark.createDataFrame([(text,), ('{"key":"A"}',)], "raw string")
    assert documents.parse(raw).where("doc IS NULL").count() == 1


def test_rules_inside_mixed_shapes(spark):
    """A field of several shapes: dates converted, empty objects nulled at any depth, nothing else touched."""
    import json

    from tablesync.operators import documents

    date, utc = "2024-03-05T10:00:00.000+1100", "2024-03-04 23:00:00.000000"
    tricky = {'a":{}': "x", "b\\": ':{},"c":{}', "c": ["{}", ":{}", {}, [{}], {"d": {}}], "nl\n\t\u0001\u0002": "\u0001{}\u0002", "é": date + " x"}
    values = [
        "text", date, 5, 1.5, True, None, {}, [], [{}], {"at": date, "e": {}}, [date, {"e": {"f": {}}}, "2024-03-05"], tricky,
        {"deep": [[[{"at": [date]}]]], date: date, "": {}}, {"x": None},
    ]

    def rule(v, in_list=False):
        if isinstance(v, dict):
            return v if not v and in_list else None if not v else {k: rule(x) for k, x in v.items()}
        if isinstance(v, list):
            return [rule(x, True) for x in v]
        return utc if v == date else v

    raw = [(json.dumps({"key": str(i), "id": str(i), "fields": {"m": v}}),) for i, v in enumerate(values)]
    flat = documents.flatten(*documents.staged(spark.createDataFrame(raw, "raw string")))
    got = {int(r.id): r.m for r in flat.select("id", "m").collect()}
    for i, v in enumerate(values):
        want = rule(v)
        if want is None or isinstance(want, str):
            # text that is a date with more behind it stays as it is
            assert got[i] == want, v
        else:
            assert json.loads(got[i]) == want, v
