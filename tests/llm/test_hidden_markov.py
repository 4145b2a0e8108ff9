import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import hidden_markov as hmm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall((text or "").translate(UPPER))]


def held(doc):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 == 2


def model(classes, states, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Model(
        norm(rng.random(states) + 0.1, 0), norm(rng.random((states, states)) + 0.1, 1), norm(rng.random((classes, states)) + 0.01, 0)
    )


def paths(m, text):
    """(state path, probability) of one class sequence, all paths."""
    for path in itertools.product(range(len(m.first)), repeat=len(text)):
        p = m.first[path[0]] * m.emits[text[0], path[0]]
        for t in range(1, len(text)):
            p *= m.moves[path[t - 1], path[t]] * m.emits[text[t], path[t]]
        yield path, p


TEXTS = [[0], [1, 0], [2, 2, 1, 0], [3, 1, 0], [0], [1, 2, 3, 1, 2, 0], [3, 0]]


def steps(texts, chosen=None):
    lengths = np.array([len(t) for t in texts])
    return hmm.Steps(np.concatenate([np.array(t) for t in texts]), lengths, np.arange(len(texts)) if chosen is None else chosen)


@pytest.mark.parametrize("held_tokens", [1, 3, 7, 1000])
def test_expected_counts_equal_the_sum_over_all_paths(monkeypatch, held_tokens):
    monkeypatch.setattr(hmm, "HELD_TOKENS", held_tokens)
    m = model(4, 3)
    first, moved, emitted, total = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3)), 0.0
    for text in TEXTS:
        every = list(paths(m, text))
        whole = sum(p for _, p in every)
        total += math.log10(whole)
        for path, p in every:
            first[path[0]] += p / whole
            for t, s in enumerate(path):
                emitted[text[t], s] += p / whole
                if t:
                    moved[path[t - 1], s] += p / whole
    got = m.expected(steps(TEXTS), np.float64)
    for x, y in zip(got, (first, moved, emitted, total)):
        np.testing.assert_allclose(x, y, rtol=1e-10, atol=1e-12)
    rough = m.expected(steps(TEXTS))  # single precision, as in training
    np.testing.assert_allclose(rough[2], emitted, rtol=1e-4, atol=1e-5)
    s = steps(TEXTS)
    likelihood = np.empty(len(TEXTS))
    likelihood[s.order] = m.log_likelihoods(s)
    np.testing.assert_allclose(likelihood, [math.log10(sum(p for _, p in paths(m, t))) for t in TEXTS], rtol=1e-12)


def test_no_text():
    m = model(4, 2)
    first, moved, emitted, total = m.expected(steps(TEXTS, np.array([], int)))
    assert total == 0 and not emitted.any() and not moved.any() and not first.any()


def test_an_iteration_never_lowers_the_likelihood():
    m, last = model(4, 3, seed=2), -math.inf
    for _ in range(15):
        first, moved, emitted, total = m.expected(steps(TEXTS * 50), np.float64)
        assert total >= last - 1e-9
        last = total
        m = hmm.Model(first / first.sum(), moved / moved.sum(1, keepdims=True), emitted / emitted.sum(0))


@pytest.fixture()
def small(monkeypatch):
    for name, value in {"HEAD_WORDS": 12, "TAIL_CLASSES": 5, "BLOCK_TOKENS": 40, "BUCKET_WORDS": 9, "HELD_TOKENS": 25, "STATES": 3}.items():
        monkeypatch.setattr(hmm, name, value)


def check(df, states=3, iterations=2):
    """Scores against plain ones; returns the rows."""
    seen = {}
    original = hmm.train

    def kept(texts, shares, *args):
        seen["model"] = original(texts, shares, *args)
        return seen["model"]

    hmm.train = kept
    try:
        got = hmm.score_texts(df, states, iterations).collect()
    finally:
        hmm.train = original
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    train = Counter()
    docs = 0
    for doc, text in rows:
        if not held(doc):
            docs += 1
            train.update(words_of(text))
    n, v = sum(train.values()) + docs, len(train) + (docs > 0)
    # classes: heads are numbered by bucket and then by the word
    blocks = hmm.text_blocks(df)
    entries = sum(r[0] for r in blocks.select("n_words").collect())
    buckets = max(1, -(-entries // hmm.BUCKET_WORDS))
    heads = sorted((zlib.crc32(w) % buckets, w) for w, c in train.items() if c * hmm.HEAD_WORDS >= n)
    assert len(heads) <= hmm.HEAD_WORDS
    number = {w: hmm.TAIL_CLASSES + k for k, (_, w) in enumerate(heads)}
    end = hmm.TAIL_CLASSES + len(heads)
    tokens, singles = Counter(), Counter()
    for w, c in train.items():
        if w not in number:
            tokens[hmm.tail_class(w)] += c
            singles[hmm.tail_class(w)] += c == 1
    m = seen["model"]
    assert m.emits.shape == (end + 1, states)
    np.testing.assert_allclose(m.emits.sum(0), 1)

    def score(text):
        log, a = 0.0, None
        for w in [*words_of(text), None]:
            k = end if w is None else number.get(w, hmm.tail_class(w))
            inside = 1.0
            if k < hmm.TAIL_CLASSES:
                inside = (train[w] or singles[k] + 1) / (tokens[k] + singles[k] + 1)
            a = (m.first if a is None else a @ m.moves) * m.emits[k]
            log += math.log10(a.sum() * inside)
            a = a / a.sum()
        return log

    def row(doc, text):
        w = words_of(text)
        counts = [train[x] for x in w] + [docs]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in counts)
        return doc, held(doc), len(counts), sum(c > 0 for c in counts), n, base, score(text)

    key = lambda r: tuple(str(x) if not isinstance(x, float) else round(x, 4) for x in r)
    want = sorted((row(*r) for r in rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(sorted((tuple(r) for r in got), key=key), want):
        assert g[:5] == w[:5]
        np.testing.assert_allclose(g[5:], w[5:], rtol=1e-9)
    return got


def test_hard_texts(spark, edge_docs, with_clashes, small):
    check(with_clashes(edge_docs.union(edge_docs)))


def test_one_long_text(spark, small):
    check(spark.createDataFrame([(1, "a b " * 500 + "c"), (2, "a"), (2, "a")], "doc_id long, text string"))


def test_nothing_to_learn_from(spark, small):
    held_out = [i for i in range(60) if held(i)]
    check(spark.createDataFrame([(i, "a b A") for i in held_out] + [(held_out[0], None)], "doc_id long, text string"))


def test_empty(spark, empty_docs):
    assert hmm.score_texts(empty_docs).count() == 0


def test_shares_of_a_class_sum_to_one(spark, documents):
    blocks = hmm.text_blocks(documents).cache()
    n, docs, entries = blocks.agg(F.sum("train_tokens"), F.sum("train_docs"), F.sum("n_words")).first()
    counted = hmm.counted_words(blocks, n, 3).cache()
    corpus = hmm.Corpus(counted, n, docs)
    assert corpus.tails[0].sum() + round((corpus.shares[hmm.TAIL_CLASSES :] * (n + len(corpus.shares)) - 1).sum()) == n
    assert abs(corpus.shares.sum() - 1) < 1e-12
    sums = Counter()
    words = {}
    for r in counted.filter("block IS NOT NULL").collect():
        for i, c, k in zip(np.frombuffer(r.ids, "<u4"), np.frombuffer(r.counts, "<i8"), np.frombuffer(r.classes, "<i4")):
            words[r.block, int(i)] = (int(c), int(k))
    lists = {r.block: hmm.split_words(bytes(r.words)) for r in blocks.select("block", "words").collect()}
    distinct = {lists[b][i]: x for (b, i), x in words.items()}
    for c, k in distinct.values():
        if k >= 0 and c:
            sums[k] += c / (corpus.tails[0][k] + corpus.tails[2][k] + 1)
    for k, s in sums.items():
        assert math.isclose(s + (corpus.tails[2][k] + 1) / (corpus.tails[0][k] + corpus.tails[2][k] + 1), 1)


def test_held_out_texts_gain_over_the_base_and_over_one_state(spark, sf_dir, documents):
    def held_out(states):
        rows = hmm.score_texts(documents, states, 8).filter("held_out").collect()
        return sum(r.score for r in rows), sum(r.base_score for r in rows)

    one, base = held_out(1)
    many, _ = held_out(4)
    assert many > one > base


def test_every_iteration_reads_all_training_texts(spark, small, monkeypatch):
    """No iteration learns from a share of the blocks."""
    docs = spark.createDataFrame([(i, f"a b{i % 7} c{i % 5} " * 12) for i in range(60)], "doc_id long, text string")
    read = []
    original = hmm.improved

    def kept(texts, model, shares):
        read.append(sum(n for r in texts.collect() for n, held in zip(r.lengths, r.held) if not held))
        return original(texts, model, shares)

    monkeypatch.setattr(hmm, "improved", kept)
    rows = hmm.score_texts(docs, 3, 4).collect()
    assert read == [rows[0].train_tokens] * 4
