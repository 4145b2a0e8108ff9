import random
import re

import xxhash
from pyspark.sql import functions as F

from tablesync.llm import simhash
from tablesync.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=2):
    """Root (smallest position) of each fingerprint, all pairs compared."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(k) for k in range(len(prints))]


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    smallest = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            smallest[r] = min(smallest.get(r, i), i)
    return sorted(((i, f"{p:016x}", smallest.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=str)


def hexed(df):
    return sorted(
        (tuple(r) for r in df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()), key=str
    )


def test_matches_brute_force(documents, edge_docs, with_clashes):
    for docs in (documents, with_clashes(edge_docs)):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert hexed(simhash.near_duplicates(docs)) == brute(rows)


def test_empty(empty_docs):
    assert simhash.near_duplicates(empty_docs).count() == 0
    assert simhash.keep_one(empty_docs).count() == 0


def cluster(n, seed):
    rng = random.Random(seed)
    out = set()
    for centre in [rng.getrandbits(64) for _ in range(6)]:
        for _ in range(n // 6):
            x = centre
            for _ in range(rng.randint(0, 7)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def roots_of(spark, prints, at_once):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.v: r.root for r in components(simhash.links(df, 2, at_once)).collect()}
    return [found.get(p, p) for p in signed]


def partition(labels):
    seen = {}
    return [seen.setdefault(x, len(seen)) for x in labels]


def test_links_connect_exactly_what_is_near(spark):
    prints = cluster(240, 5)
    want = partition(brute_components(prints))
    assert partition(roots_of(spark, prints, 4096)) == want
    assert partition(roots_of(spark, prints, 3)) == want  # oversized groups go the other way


def test_keep_one(edge_docs, with_clashes):
    docs = with_clashes(edge_docs)
    kept = simhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted(groups, key=str)


def test_components_of_a_path(spark):
    n = 200
    path = spark.range(n - 1).select((F.col("id") * 7 % n).alias("a"), ((F.col("id") + 1) * 7 % n).alias("b"))
    got = components(path).collect()
    assert len(got) == n and {r.root for r in got} == {0}
