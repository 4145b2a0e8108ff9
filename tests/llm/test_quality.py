import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_counts(documents, edge_docs, empty_docs, with_clashes):
    for docs in (documents, with_clashes(edge_docs), empty_docs):
        got = sorted((tuple(r)[:7] for r in quality.verdicts(docs).collect()), key=str)
        want = sorted(((r.doc_id, *brute_counts(r.text)) for r in docs.select("doc_id", "text").collect()), key=str)
        assert got == want


def brute_mcd(x):
    """The same concentration steps on one group, in memory."""
    ridge = np.diag(np.array(list(quality.FEATURES.values())) ** 2)
    mean = np.median(x, axis=0)
    scatter = np.diag((np.median(abs(x - mean), axis=0) * 1.4826) ** 2) + ridge
    distance = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)
    for _ in range(quality.STEPS):
        d = distance()
        core = x[d <= np.quantile(d, quality.CORE, method="inverted_cdf")]
        mean, scatter = core.mean(axis=0), np.cov(core.T, bias=True) * quality.consistency(quality.CORE) + ridge
    near = x[distance() <= quality.chi2_quantile(quality.REWEIGHT, quality.SIZE)]
    mean, scatter = near.mean(axis=0), np.cov(near.T, bias=True) * quality.consistency(quality.REWEIGHT) + ridge
    return distance()


def test_estimate_and_verdict(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = documents.withColumn("source", F.lit("one")).withColumn("lang", F.lit("one"))
    rows = one.select("doc_id", "text").collect()
    x = {r.doc_id: quality.statistics(r.text) for r in rows if not brute_counts(r.text)[5]}
    d = brute_mcd(np.array([v[5] for v in x.values()]))
    far = {i for i, v in zip(x, d) if v > quality.chi2_quantile(quality.CUTOFF, quality.SIZE)}
    got = quality.verdicts(one).collect()
    assert {r.doc_id for r in got if not r.kept and not r.base_failed} == far
    assert far
    # junk goes, clean documents stay
    judged = quality.verdicts(documents).join(labels, "doc_id").filter("NOT base_failed")
    by = {r.quality: r for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert by[1].kept == 1.0 and by[0].kept <= 0.1


def test_keep_good(edge_docs, documents, with_clashes):
    for docs in (with_clashes(edge_docs), documents):
        kept = quality.keep_good(docs)
        assert kept.dtypes == docs.dtypes
        want = sorted(str(r.doc_id) for r in quality.verdicts(docs).collect() if r.kept)
        assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_chi_squared():
    # fixed values of the distribution's tables
    assert abs(quality.chi2_quantile(0.95, 8) - 15.507) < 1e-3
    assert abs(quality.chi2_quantile(0.975, 10) - 20.483) < 1e-3


def planted(rng, n, share, centre):
    """Clean rows around a centre, and junk far off in one direction."""
    ridge = np.array(list(quality.FEATURES.values()))
    mix = rng.normal(size=(quality.SIZE, quality.SIZE)) * 0.4 + np.eye(quality.SIZE)
    x = centre + rng.normal(size=(n, quality.SIZE)) @ mix * ridge * 1.5
    junk = np.arange(n) < share * n
    x[junk] += ridge * (25 + 10 * rng.random((junk.sum(), 1))) * np.where(rng.random(quality.SIZE) < 0.5, 1, -1)
    return x, junk


@pytest.mark.parametrize("subset", [120, 1500])
def test_groups_with_much_junk(spark, monkeypatch, subset):
    """Several groups and subsets, 0 to 40% junk, and groups too small for an estimate of
    their own: the same verdicts as steps in memory, all junk rejected, all clean rows kept."""
    monkeypatch.setattr(quality, "SUBSET", subset)
    rng = np.random.default_rng(4)
    groups, rows, clean = {}, [], {}
    for k, (lang, source, n, share) in enumerate(
        [("en", "a", 1200, 0.3), ("en", "b", 700, 0.4), ("de", None, 900, 0.2), (None, "c", 500, 0.0), ("en", "few", 30, 0.3)]
    ):
        x, junk = planted(rng, n, share, centre=k * 0.3)
        for v, bad in zip(x, junk):
            clean[len(rows)] = not bad
            groups.setdefault((lang, source), []).append(len(rows))
            rows.append((len(rows), lang, source, v.tolist()))
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, x array<double>")
    params = {r.level: r for r in quality.fit(df.repartition(7)).collect()}
    cutoff = quality.chi2_quantile(quality.CUTOFF, quality.SIZE)
    x = np.array([r[3] for r in rows])
    for (lang, source), ids in groups.items():
        if len(ids) < quality.FEWEST:
            ids_of_estimate = [i for g, m in groups.items() if g[0] == lang for i in m]
            level = '{"lang":"%s"}' % lang
        else:
            ids_of_estimate = ids
            level = '{"lang":%s,"source":%s}' % tuple("null" if v is None else f'"{v}"' for v in (lang, source))
        want = brute_mcd(x[ids_of_estimate])
        p = params[level]
        z = x[ids_of_estimate] - np.array(p["mean"])
        got = np.einsum("ij,jk,ik->i", z, np.array(p["inverse"]).reshape(quality.SIZE, -1), z)
        assert ((got > cutoff) == (want > cutoff)).all()
        if len(ids) >= quality.FEWEST:
            assert [v <= cutoff for v in got] == [clean[i] for i in ids]
