"""SimHash near-dedup: deletion-variant signatures.

Fingerprints of 64 bits that differ in at most two bits agree, in one of their two
32-bit segments, on all bits but at most one.  Each distinct fingerprint is
therefore indexed under its 64 one-wildcard segment variants (segment, wildcard
place, segment without that bit); fingerprints that share a variant are compared
in full.  Equal fingerprints are merged first, so copies cost nothing here.

A variant's fingerprints are compared in one task only up to ``compared_at_once``;
larger groups are split exactly: two of their members that differ in at most two
bits share a key with a second wildcard (or two wildcards in the other segment),
and at most four fingerprints share such a key.  Tasks return, for each variant,
a star per connected set of its members rather than all pairs.

Defined results: a text without words (null, empty, white space) has fingerprint
zero; fewer words than a shingle make one shingle of all; a null ``doc_id`` is never
the smallest of its component unless all are null; rows with the same ``doc_id`` are
treated one by one and repeated rows get equal results; an empty table gives an
empty result; extra columns are ignored by :func:`near_duplicates` and kept by
:func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import free_name, stored, table, text_slices, utf8
from tablesync.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
COMPARED_AT_ONCE = 4096
HASHES_AT_ONCE = 255 * 256
STREAMED = "hot boolean, key long, a long, b long"


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = utf8(text).lower().split()  # bytes: A-Z only, and the six white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        spans = [(0, len(joined))]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        spans = zip((ends - sizes)[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[start : start + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of up to 255 bits fit a byte
        if whole:
            counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document; ``fp`` holds the bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            prints = np.array([fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()], "<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view("<i8"))], names=["doc_id", "text_hash", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` positions the smallest that links ``a[i]``-``b[i]`` reach."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        for side in (a, b, before[a], before[b]):
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == before).all():
            return root


def _stream(max_bits: int, at_once: int):
    def links_of(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        """Stars over groups that are whole and of at most ``at_once`` members."""
        in_pair = np.zeros(len(key), bool)
        in_pair[1:] = key[1:] == key[:-1]
        in_pair[:-1] |= in_pair[1:]
        key, fp = key[in_pair], fp[in_pair]
        left, right, live, step = [], [], np.arange(len(key)), 1
        while True:
            live = live[live + step < len(key)]
            live = live[key[live] == key[live + step]]
            if not len(live):
                break
            near = np.bitwise_count(fp[live].view("<u8") ^ fp[live + step].view("<u8")) <= max_bits
            left.append(live[near])
            right.append(live[near] + step)
            step += 1
        if not left:
            return None
        root = stars(np.concatenate(left), np.concatenate(right), len(key))
        leaf = np.flatnonzero(root != np.arange(len(key)))
        return rows(False, key[leaf], fp[leaf], fp[root[leaf]]) if len(leaf) else None

    def rows(hot: bool, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), hot)), pa.array(key), pa.array(a), pa.array(b)], names=["hot", "key", "a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the group not yet known to be whole
        hot = None  # the key of a group that proved too large
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False)])
            if not len(key):
                continue
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(begins, len(key)))
            large = (sizes > at_once) | (key[begins] == hot if hot is not None else False)
            in_large = np.repeat(large, sizes)
            if in_large.any():
                yield rows(True, key[in_large], fp[in_large], fp[in_large])
            hot = int(key[-1]) if large[-1] else None
            whole = ~in_large
            if not large[-1]:
                whole[begins[-1] :] = False
            out = links_of(key[whole], fp[whole])
            if out is not None:
                yield out
            tail = slice(len(key), None) if large[-1] else slice(begins[-1], None)
            key, fp = key[tail], fp[tail]
        out = links_of(key, fp)
        if out is not None:
            yield out

    return run


def _variants(fp) -> list:
    """The 64 one-wildcard segment variants: (segment, place) above, masked segment below."""
    out = []
    for segment in range(2):
        bits = F.shiftrightunsigned(fp, 32) if segment else fp.bitwiseAND(F.lit(0xFFFFFFFF))
        for place in range(32):
            out.append(
                bits.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << place))).bitwiseOR(F.lit((segment * 32 + place) << 32))
            )
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _hot_links(hot: DataFrame) -> DataFrame:
    """Links inside oversized variants, by keys that at most four fingerprints share."""
    # a pair of places -> the mask of all other bits; fixed by the number of bits, not by the data
    keep = lambda p, q: F.lit(_signed(((1 << 64) - 1) ^ (1 << p) ^ (1 << q)))
    pair = lambda p, q: F.struct(F.lit(p * 64 + q).alias("pair"), F.col("a").bitwiseAND(keep(p, q)).alias("rest"))
    place = F.shiftright("key", 32)
    branches = None
    for p in range(64):
        other = range(32, 64) if p < 32 else range(32)
        keys = [pair(min(p, q), max(p, q)) for q in other]
        if p % 32 == 0:  # equal in this segment, two bits in the other: once for the segment
            keys += [pair(q, r) for q in other for r in other if q < r]
        part = hot.filter(place == p).select("a", F.explode(F.array(*keys)).alias("at")).select("a", "at.*")
        branches = part if branches is None else branches.unionByName(part)
    few = branches.groupBy("pair", "rest").agg(F.collect_set("a").alias("members"))
    few = few.filter(F.size("members") > 1)
    return few.select(F.explode("members").alias("a"), F.array_min("members").alias("b")).filter("a <> b")


def links(prints: DataFrame, max_bits: int = MAX_BITS, compared_at_once: int = COMPARED_AT_ONCE) -> DataFrame:
    """(a, b) of distinct fingerprints: enough links to connect all within ``max_bits`` (2 at most)."""
    if max_bits > 2:
        raise ValueError("two segments find at most two differing bits")
    variants = prints.select("fp", F.explode(F.array(*_variants(F.col("fp")))).alias("key"))
    streamed = stored(
        variants.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_stream(max_bits, compared_at_once), STREAMED),
        "simhash-links",
    )
    found = streamed.filter("NOT hot").select("a", "b")
    hot = streamed.filter("hot")
    if not hot.isEmpty():
        found = found.unionByName(_hot_links(hot).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return found.distinct()


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    compared_at_once: int = COMPARED_AT_ONCE,
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of every document."""
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    linked = components(links(distinct, max_bits, compared_at_once))
    vertices = distinct.join(linked.withColumnRenamed("v", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = vertices.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = vertices.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document, the one of the smallest ``doc_id``, of each component."""
    groups = near_duplicates(docs, shingle_words, max_bits)
    # a row of its own kind for null ids: a component without any id keeps one of its texts
    first = groups.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("row")
    )
    id_, hash_, nth = (free_name(docs, x) for x in ("first_doc_id", "first_text_hash", "copy_number"))
    first = first.select(F.col("row.doc_id").alias(id_), F.col("row.text_hash").alias(hash_))
    keyed = docs.withColumn(hash_ + "_own", F.xxhash64("text"))
    same = keyed["doc_id"].cast("long").eqNullSafe(first[id_]) & (keyed[hash_ + "_own"] == first[hash_])
    kept = keyed.join(first, same)
    # the same row given several times counts once
    copies = Window.partitionBy(id_, hash_).orderBy(F.lit(0))
    return kept.withColumn(nth, F.row_number().over(copies)).filter(F.col(nth) == 1).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
