import hashlib
import random
import re

import numpy as np

from tablesync.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    last = float("inf")
    split = [(last if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    smallest = {}
    for order, _, words in split:
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            smallest[key] = min(smallest.get(key, last), order)
    out = []
    for order, i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if smallest[tuple(words[k : k + window])] < order:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs, window=13):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in substring_dedup.substring_digest(docs, window).collect()), key=str)
    assert got == brute(rows, window)


def test_matches_brute_force(documents, edge_docs, empty_docs, with_clashes):
    check(documents)
    check(with_clashes(edge_docs))
    check(empty_docs)


def test_small_vocabulary(spark):
    rng = random.Random(3)
    words = ["a", "of", "the", "thing", "other", "longer"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, 5)
    check(docs, 7)


def test_hash_collisions_are_settled_by_text(monkeypatch):
    entries = [b"one two three four five six seven", b"one two three four five six eight", b"two three four five six seven"]
    docs = np.array([5, 3, 1])
    right = substring_dedup.first_documents(entries, docs, 5)
    monkeypatch.setattr(substring_dedup.Spans, "hashes", lambda self, a, b: np.zeros(len(a), np.uint64))
    forced = substring_dedup.first_documents(entries, docs, 5)
    as_set = lambda x: {tuple(map(int, r)) for r in zip(*x)}
    assert as_set(right) == as_set(forced) == {(0, 0, 3), (0, 1, 1), (0, 2, 1), (1, 1, 1)}


def heavy_rows():
    """One word 3-gram in many different contexts; some documents share theirs."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    rows = []
    for k in range(400):
        around = [[word() for _ in range(14)] for _ in range(2)]
        rows.append((k, " ".join([*around[0], "universal", "declaration", "concerning", *around[1]])))
    return rows + [(400 + k, "again " + rows[k * 7][1]) for k in range(50)]


def test_heavy_minimiser_is_dealt_over_buckets(spark, monkeypatch):
    # a 3-gram that is the minimiser of all the windows it stands in
    plain = substring_dedup.Spans.hashes

    def hashes(self, first, last):
        out = plain(self, first, last)
        grams = np.flatnonzero(last - first == substring_dedup.GRAM - 1)
        data = self.bytes.tobytes()
        for k in grams:
            if data[self.starts[first[k]] : self.ends[last[k]]] == b"universal declaration concerning":
                out[k] = 1
        return out

    monkeypatch.setattr(substring_dedup.Spans, "hashes", hashes)
    rows = heavy_rows()
    ids, texts = np.array([i for i, _ in rows]), [t for _, t in rows]

    def largest(*heavy):
        block = substring_dedup.Block(ids, texts, 13, 64, *heavy)
        sizes = np.bincount(block.entry_bucket, weights=[len(t) for t in block.entry_text])
        return sizes.max() / sizes.sum()

    assert largest() > 0.2
    assert largest(np.array([1], np.uint64)) < 0.05


def test_heavy_minimisers_are_found_and_exact(spark, monkeypatch):
    docs = spark.createDataFrame(heavy_rows(), "doc_id long, text string")
    dealt = docs.selectExpr("doc_id AS doc", "text", "xxhash64(text) AS text_hash", "pmod(xxhash64(doc_id), 16) AS block")
    found, size = substring_dedup.heavy_keys(dealt, 16, 13, 4000)
    assert len(found) >= 1 and size > 4000
    assert len(substring_dedup.heavy_keys(dealt, 16, 13, 1 << 30)[0]) == 0
    seen = []
    plain = substring_dedup.heavy_keys
    monkeypatch.setattr(substring_dedup, "heavy_keys", lambda *a: seen.append(plain(*a)) or seen[-1])
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 4000)
    check(docs)
    assert len(seen[0][0])


def test_kept_text(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "x a b c d e y"), (None, "a b c d e")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in substring_dedup.dedup_substrings(docs, 5).collect()}
    assert got == {1: "a b c d e f", 2: "x y", None: ""}
