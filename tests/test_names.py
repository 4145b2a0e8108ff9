import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.functions.names import clean_identifier, clean_name, type_table_name, type_table_name_col

CASES = [
    ("Mise à jour", "Mise_a_jour"),
    ("2e ligne", "_2e_ligne"),
    ("Coût (k€)", "Cout__k__"),
    ("œuvre", "_uvre"),
    ("²A", "_2A"),
    ("½", "_1_2"),
    ("Sous-tâche", "Sous_tache"),
    ("_x", "_x"),
    ("9" * 130, "_" + "9" * 127),
    ("", "_"),
]


def test_clean_name_cases():
    for raw, want in CASES:
        assert clean_name(raw) == want, raw


def test_clean_identifier_column_agrees(spark):
    df = spark.createDataFrame([(r,) for r, _ in CASES], "s string")
    got = [r[0] for r in df.select(clean_identifier("s")).collect()]
    assert got == [w for _, w in CASES]


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(clean_identifier("s")).first()[0] is None


def test_type_table_names(spark):
    assert type_table_name("Tâche", False) == "Tache"
    assert type_table_name("Tâche", True) == "Tache_subtask"
    df = spark.createDataFrame([("Tâche", False), ("Tâche", True), ("Tâche", None)], "n string, s boolean")
    got = [r[0] for r in df.select(type_table_name_col("n", "s")).collect()]
    assert got == ["Tache", "Tache_subtask", "Tache"]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_clean_name_shape(s):
    assert re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]{0,127}", clean_name(s))


def test_column_and_python_forms_agree_on_random_text(spark):
    import random

    rnd = random.Random(7)
    alphabet = "aàâäéèêëîïôöùûüçœæÅÉ²³½¼ﬁﬂ①ⅫＡＢ 0123456789-_/().€°ñãõ한글中文" + "́̈"
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(clean_identifier(F.col("s"))).collect()]
    assert got == [clean_name(s) for s in samples]
