import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tablesync.llm import spelling

LETTERS = "abcdeàÿ"
UPPER = {c: c + 32 for c in range(65, 91)}


def one_edit(u, v):
    """Brute force: exactly one code point inserted, deleted or replaced."""
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute_words(rows, least=spelling.MIN_COUNT):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= least}


def brute(rows):
    n = brute_words(rows)
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=str)


def result(df):
    rows = spelling.group_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((tuple(r) for r in rows), key=str)


def check(df):
    got = result(df)
    assert got == brute([tuple(r) for r in df.select("doc_id", "text").collect()])
    return got


def random_words(rng, n):
    words = {"".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 9))) for _ in range(n)}
    words |= {"aaaaaa" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(n)}
    return sorted(words)


def test_acceptor_is_minimal_and_exact():
    rng = random.Random(5)
    words = random_words(rng, 120)
    states, initial = spelling.minimal_acceptor(words)
    found, stack = set(), [("", initial)]
    while stack:
        path, s = stack.pop()
        if states[s][0]:
            found.add(path)
        stack += [(path + c, t) for c, t in states[s][1].items()]
    assert found == set(words)
    residuals = {frozenset(w[i:] for w in words if w[:i] == p[:i]) for p in words for i in range(len(p) + 1)}
    assert len(states) == len(residuals)  # one state a right language


def test_composition_accepts_the_pairs_one_edit_apart():
    rng = random.Random(6)
    for n in (1, 2, 30, 150):
        words = random_words(rng, n)
        pairs = [tuple(sorted(p)) for p in spelling.Composition(words).pairs()]
        want = {(u, v) for u in words for v in words if u < v and one_edit(u, v)}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


@pytest.mark.parametrize("state_words", [1, 3, 40, 2000])
def test_pairs_across_initial_states(spark, monkeypatch, state_words):
    monkeypatch.setattr(spelling, "STATE_WORDS", state_words)
    words = random_words(random.Random(7), 150)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    got = sorted((r.word, r.near, r.near_n) for r in spelling.near_words(df).collect())
    number = {w: i for i, w in enumerate(words)}
    assert got == sorted((u, v, number[v]) for u in words for v in words if u != v and one_edit(u, v))


def hard_rows():
    rng = random.Random(8)
    base = ["garden", "gardens", "gardén", "ÀÿÀÿÀÿ", "street", "streets", "aaaaaaa", "aaaaaaaa", "x" * 3000, "x" * 3001]
    rows = [(i, " ".join(rng.choices(base, weights=[200, 30, 4, 9, 99, 7, 50, 9, 2, 1], k=30)) + " GARDEN tiny, Straße×÷") for i in range(60)]
    rows += [(i, f"word{i} gar\x00den garden\U0001f600gardens strełet") for i in range(60, 70)]
    rows += [(None, None), (None, "garden garden"), (71, ""), (72, "1 2 \t\n"), (73, "streetz " * 9), (73, "streetz " * 9)]
    rows += [(74, "streeta " * 60 + "streetb " * 60)]  # a tie
    return rows


@pytest.mark.parametrize("state_words", [2, 2000])
def test_hard_texts(spark, monkeypatch, state_words):
    monkeypatch.setattr(spelling, "STATE_WORDS", state_words)
    df = spark.createDataFrame(hard_rows(), "doc_id long, text string").repartition(3)
    for name in ("word", "n", "near", "depth", "prefix", "form", "root", "rest", "at"):
        df = df.withColumn(name, F.lit("clash"))
    got = check(df)
    forms = {r[0]: r[1] for r in got}
    assert forms["gardens"] == "garden" and forms["x" * 3000] is None


def test_flushing_keeps_counts(spark, monkeypatch, edge_docs):
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    check(edge_docs)


def test_empty(spark, empty_docs):
    assert result(empty_docs) == []


def test_generated_equals_sql(spark, sf_dir, documents, monkeypatch):
    monkeypatch.setattr(spelling, "STATE_WORDS", 50)
    got = check(documents)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
    want = con.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({spelling.ORACLE})").fetchall()
    assert got == sorted(want, key=str) and any(r[1] for r in got)
