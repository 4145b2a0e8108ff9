import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights, intercept = toxicity.train(docs, labels)
    got = toxicity.score_documents(docs, weights, intercept).join(labels, "doc_id").filter("held_out")
    by = {(r.toxic, r.predicted): r.n for r in got.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    caught, missed = by.get((1, 1), 0), by.get((1, 0), 0)
    # some labelled texts no longer hold the words they were labelled for
    assert caught / (caught + missed) >= 0.85
    assert by.get((0, 1), 0) / by[(0, 0)] <= 0.01


def test_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in toxicity.query(spark, sf_dir).collect()}
    assert len(got) == documents.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def biased_rows():
    """Texts that name one group are mostly toxic, for an insult beside it."""
    rng = np.random.default_rng(0)
    filler = ["day", "tree", "river", "walk", "house", "green"]
    for k in range(400):
        toxic = k % 4 == 0
        words = list(rng.choice(filler, 4))
        if toxic:
            words += ["muslims"] * (k % 8 == 0) + ["scumbag"] * (rng.random() < 0.85)
        yield int(toxic), set(words)


def test_swaps_reduce_false_positives_on_neutral_mentions():
    rows = list(biased_rows())
    words = sorted(toxicity.CATEGORY_OF.keys() - toxicity.NEUTRAL.keys()) + ["day", "tree", "river", "walk", "house", "green", "scumbag"]
    y, texts = np.array([t for t, _ in rows]), [w for _, w in rows]

    def change(penalty):
        w, w0 = toxicity.fit(y, texts, words, penalty)
        at = dict(zip(words, w))
        score = lambda present: 1 / (1 + np.exp(-w0 - sum(at.get(x, 0.0) for x in present)))
        return score({"tree", "muslims"}), score({"tree", "believers"}), score({"tree", "scumbag"})

    plain, regular = change(0.0), change(toxicity.COUNTERFACTUAL)
    assert plain[0] >= 0.5 > regular[0]  # the neutral mention is no longer flagged
    assert abs(regular[0] - regular[1]) < 0.05 < abs(plain[0] - plain[1])
    assert regular[2] >= 0.5  # the insult still is


def test_swaps_reach_beginnings(spark):
    """The biased texts through words_of() and vocabulary(): no beginning keeps the name's weight."""
    texts = [(k, int(t), " ".join(sorted(w))) for k, (t, w) in enumerate(biased_rows())]
    docs = spark.createDataFrame([(k, x) for k, _, x in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(k, None, t) for k, t, _ in texts], LABELS)
    weights, intercept = toxicity.train(docs, labels)
    assert any(w.endswith("-") and "muslims".startswith(w[:-1]) for w in toxicity.vocabulary(toxicity.labelled_words(docs, labels)))
    score = lambda text: 1 / (1 + np.exp(-intercept - sum(weights.get(w, 0.0) for w in toxicity.words_of(text))))
    assert score("tree muslims") < 0.5 <= score("tree scumbag")
    assert abs(score("tree muslims") - score("tree believers")) < 0.05


def test_fit_swaps_whole_texts():
    rows = [(t, toxicity.words_of(" ".join(w))) for t, w in biased_rows()]
    words = sorted(toxicity.CATEGORY_OF.keys() - toxicity.NEUTRAL.keys()) + ["musl-", "musli-", "muslim-", "scumbag"]
    w, w0 = toxicity.fit(np.array([t for t, _ in rows]), [x for _, x in rows], words)
    at = dict(zip(words, w))
    score = lambda text: 1 / (1 + np.exp(-w0 - sum(at.get(x, 0.0) for x in toxicity.words_of(text))))
    assert score("tree muslims") < 0.5 <= score("tree scumbag")
    # names that share beginnings are also swapped together
    lost = {frozenset(a) for a, _ in toxicity.changes_of({"muslims", "muslime"}, 0, {"musl-"})}
    assert frozenset({"musl-"}) in lost


def test_singular_names_are_swapped():
    for word in ("muslim", "jew", "christian", "immigrant", "refugee", "woman", "man", "jude", "musulman", "mujer"):
        neutral = toxicity.CATEGORIES[toxicity.CATEGORY_OF[word]][0]
        assert (word, neutral) in toxicity.pairs_of({word, "tree"}, 0)
    # a word has one category, and a neutral word is no name
    words = [w for names in toxicity.CATEGORIES.values() for w in names]
    assert len(words) == len(set(words)) and all(w == w.lower() and toxicity.WORD.fullmatch(w) for w in words)
    rows = [(t, toxicity.words_of(" ".join("muslim" if x == "muslims" else x for x in w))) for t, w in biased_rows()]
    names = sorted(toxicity.CATEGORY_OF.keys() - toxicity.NEUTRAL.keys())
    words = names + [w for w in ("musl-", "musli-", "muslim", "scumbag") if w not in names]
    w, w0 = toxicity.fit(np.array([t for t, _ in rows]), [x for _, x in rows], words)
    at = dict(zip(words, w))
    score = lambda text: 1 / (1 + np.exp(-w0 - sum(at.get(x, 0.0) for x in toxicity.words_of(text))))
    assert score("tree muslim") < 0.5 <= score("tree scumbag")


def test_hard_inputs(spark, edge_docs, empty_docs, with_clashes):
    docs = with_clashes(edge_docs)
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(12)] + [(5, None, None), (None, 1, 1)], LABELS)
    weights, intercept = toxicity.train(docs, labels)
    got = toxicity.score_documents(docs, weights, intercept).collect()
    assert len(got) == docs.count()
    assert all(not r.held_out for r in got if r.doc_id is None)
    base = 1 / (1 + np.exp(-intercept))
    assert all(r.score == pytest.approx(base) for r in got if r.doc_id in (2, 3, 4))
    assert toxicity.score_documents(empty_docs, weights, intercept).count() == 0
    nothing = spark.createDataFrame([], LABELS)
    weights, intercept = toxicity.train(docs, nothing)
    assert weights == {} and 1 / (1 + np.exp(-intercept)) == pytest.approx(0.5)


def test_the_sample_is_bounded_whatever_repeats(spark):
    rows = [(1, "scumbag tree")] * 1000 + [(1, "other text")] * 1000 + [(k, f"day tree {k}") for k in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0)] * 500 + [(1, 1, 1)] + [(k, 1, 0) for k in range(2, 300)] * 2, LABELS)
    train_ids = {k for k in range(1, 300) if zlib.crc32(str(k).encode()) % 5}
    for bound in (2, 7, 50, 10_000):
        sample = [tuple(r) for r in toxicity.labelled_sample(labels, bound).collect()]
        assert len(sample) == len(dict(sample)) <= bound and set(dict(sample)) <= train_ids
        assert len(sample) >= min(bound, len(train_ids)) // 5
        assert toxicity.labelled_words(docs, labels, bound).count() == len(sample)
    assert dict(sample)[1] == 1 and len(sample) == len(train_ids)  # toxic, as one of its labels is
    # the model does not change with the number of copies
    once = spark.createDataFrame(sorted(set(rows)), "doc_id long, text string")
    assert toxicity.train(docs, labels) == toxicity.train(once, labels.distinct())


def test_vocabulary_without_limits(spark):
    docs = spark.createDataFrame([(k, f"word{'x' * (k % 5)} scumbag" if k % 3 == 0 else f"tree{'y' * (k % 4)}") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(60)], LABELS)
    rows = toxicity.labelled_words(docs, labels)
    words = {w for r in rows.collect() for w in r.words}
    assert words <= set(toxicity.vocabulary(rows, None, 0.0))
    assert len(set(toxicity.vocabulary(rows, 1)) - toxicity.CATEGORY_OF.keys()) == 1
    weights, _ = toxicity.train(docs, labels, vocabulary_size=None, associated=0.0)
    assert any(w.startswith("tree") for w in weights)


def test_fit_and_scores_equal_plain_ones(spark):
    """The objective by loops over texts and swaps is flat at the fitted weights; scores by loops."""
    rows = [(t, toxicity.words_of(" ".join(sorted(w)))) for t, w in biased_rows()][:120]
    words = sorted({w for _, x in rows for w in x} | {"believers", "believ-"} - toxicity.NEUTRAL.keys())
    words = [w for w in words if w not in toxicity.NEUTRAL]
    w, w0 = toxicity.fit(np.array([t for t, _ in rows]), [x for _, x in rows], words)
    known = set(words)

    def objective(at, bias):
        score = lambda present: bias + sum(at.get(x, 0.0) for x in present)
        total = toxicity.RIDGE / 2 * sum(x * x for x in at.values())
        for nth, (t, present) in enumerate(rows):
            z = score(present)
            total += np.log1p(np.exp(-z)) if t else np.log1p(np.exp(z))
            for lost, gained in toxicity.changes_of(present, nth, known):
                total += toxicity.COUNTERFACTUAL / 2 * (sum(at[x] for x in gained) - sum(at[x] for x in lost)) ** 2
        return total

    at = dict(zip(words, w))
    here = objective(at, w0)
    for x in words:
        for d in (1e-3, -1e-3):
            assert objective(at | {x: at[x] + d}, w0) >= here - 1e-6
    assert min(objective(at, w0 + 1e-3), objective(at, w0 - 1e-3)) >= here - 2e-5  # after a fixed number of steps
    texts = [None, "", "tree muslims SCUMBAG", "Tree tree"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score_documents(docs, at, w0).collect():
        z = w0 + sum(at.get(x, 0.0) for x in toxicity.words_of(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-12) and r.predicted == int(r.score >= 0.5)
