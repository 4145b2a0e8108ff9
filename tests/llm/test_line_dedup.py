import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from tablesync.llm import line_dedup

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    last = float("inf")
    split = [(last if i is None else i, i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(set)
    key = lambda line: line.strip(STRIP).translate(LOWER)
    for order, _, lines in split:
        for line in lines:
            holders[key(line)].add(order)
    out = []
    for order, i, lines in split:
        left = [x for x in lines if len(key(x)) < 10 or order == min(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_matches_brute_force(documents, edge_docs, empty_docs):
    for docs in (documents, edge_docs, empty_docs):
        got = sorted((tuple(r) for r in line_dedup.line_digest(docs).collect()), key=str)
        assert got == brute(pairs(docs))


def test_hash_spanning_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the very same line\nand a second one").alias("text"))
        got = line_dedup.line_digest(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 3000
    assert {r.doc_id for r in got if r.n_dropped == 0} == {0}
    assert all(r.n_dropped == 2 for r in got if r.doc_id)


def test_batches_cut_anywhere():
    """However a partition's rows are cut into batches, the same lines come out."""
    hashes, docs = [1] * 4 + [2] * 3 + [3] + [4] * 2 + [5] * 3, [0, 1, 1, 2, 0, 2, 3, 1, 5, 6, 0, 0, 4]
    columns = [pa.array(x, pa.int64()) for x in (hashes, hashes, docs, docs)] + [pa.array([0] * len(docs), pa.int32())]
    whole = pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc", "text_hash", "pos"])

    def streamed(cuts):
        batches = [whole.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, len(docs)])]
        return sorted(tuple(r.values()) for out in line_dedup.stream_firsts(iter(batches)) for r in out.to_pylist())

    want = streamed([])
    at_hashes = [k for k in range(1, len(hashes)) if hashes[k] != hashes[k - 1]]
    assert streamed(at_hashes) == want
    assert streamed(range(1, len(hashes))) == want
    for k in range(1, len(hashes)):
        assert streamed([k]) == want


def test_dedup_keeps_columns(edge_docs, with_clashes):
    docs = with_clashes(edge_docs)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = {(r.doc_id, r.n_chars): r for r in out.collect()}
    assert out.count() == docs.count()
    assert rows[(1, len("Other line that is unique\n\nOther line that is unique"))].keep == "clash"
    assert all(r.text is None for k, r in rows.items() if k[0] == 2)
    digest = line_dedup.line_digest(docs)
    assert digest.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
