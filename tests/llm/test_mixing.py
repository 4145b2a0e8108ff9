import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablesync.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Cap and share again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        unit = left / sum(weight[s] for s in free) if free else 0
        above = {s: 2.0 * sizes[s] for s in free if unit * weight[s] > 2 * sizes[s]}
        if not above:
            return {s: capped.get(s, unit * weight[s]) for s in order}
        capped |= above


def check(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes, docs_of = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.source] += size(r.text)
    want = brute_targets(sizes)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), size(r.text)) for r in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert r.taken <= 2 * r.size
        docs_of[r.source].append(r)
    for s, own in docs_of.items():
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own) / 2 + 1e-6
        assert len({r.taken // r.size for r in own if r.size}) <= 2  # complete epochs come first
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    return got


def test_targets_and_sizes(documents, edge_docs, with_clashes):
    check(documents)
    check(with_clashes(edge_docs))


def test_order_is_efraimidis_spirakis(documents):
    got = mixing.mix(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}

    def key(i):
        u = (int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        marks = sum(c in "#*$%&|<>!" for c in texts[i])
        return -math.log(u) * (1 + marks / max(1, len(texts[i])))

    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for own in by.values():
        taken = [key(r.doc_id) for r in own if r.chosen]
        left = [key(r.doc_id) for r in own if not r.chosen and r.size]
        assert not taken or not left or max(taken) < min(left)


def test_mixed_documents(documents, edge_docs, with_clashes):
    for docs in (documents, with_clashes(edge_docs), with_clashes(edge_docs.union(edge_docs))):
        out = mixing.mixed_documents(docs)
        assert out.dtypes == docs.dtypes
        words = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(mixing.size_of(F.col("text"))).alias("n")).collect()}
        taken = {r.doc_id: r.n for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("n")).collect() if r.n}
        assert {k: v for k, v in words.items() if v} == taken


def test_empty(empty_docs, spark):
    assert mixing.mix(empty_docs).count() == 0 and mixing.mixed_documents(empty_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}


@pytest.mark.parametrize("at_once", [7, 1000])
def test_exactly_as_many_equal_rows_as_fit(spark, monkeypatch, at_once):
    """300 equal rows in three sources: no source overshoots by more than half a row."""
    monkeypatch.setattr(mixing, "ROWS_AT_ONCE", at_once)
    rows = [(1, "a b c d", s) for s in ("x", "y", None) for _ in range(100)]
    rows += [(None, "no id", "x")] * 50 + [(k, "one two three", "y") for k in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = check(docs)
    out = mixing.mixed_documents(docs)
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(mixing.size_of(F.col("text"))).alias("n")).collect()}
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert words == dict(taken)
    assert all(abs(words[s] - target[s]) <= 2 for s in target)
    copies = {(r.doc_id, r.source): r.n for r in out.groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    assert all(n <= 2 * sum(x[0] == k[0] and x[2] == k[1] for x in rows) for k, n in copies.items())
