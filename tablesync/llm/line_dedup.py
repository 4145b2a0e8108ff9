"""Line dedup: first occurrences streamed from range-partitioned line hashes.

Every line long enough becomes one row (128-bit hash, document, position).
The rows are range-partitioned on the whole sort key and sorted within the
partitions, so a task streams each hash's lines in document order and knows the
first document when it meets the others.  A hash that holds a large share of all
rows simply spans several partitions: the lines of the hash a partition *begins*
with are settled afterwards against the ends of all partitions (two rows a
partition, whatever the input).  What returns to the documents is a compressed
bitmap of kept lines for each document, never text.

Defined results: a null or empty text is one empty line; a null ``doc_id``
counts as one document that sorts last; rows with the same ``doc_id`` are one
document (its repeated lines stay); repeated rows get equal results; an empty
table gives an empty result.  Extra columns of any name pass through
:func:`dedup_lines` untouched.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import SPACE_CHARS, free_name, stored, table, text_slices, utf8

MIN_KEY_CHARS = 10
LAST_ID = np.iinfo(np.int64).max  # where a null doc_id sorts

LINES = "h1 long, h2 long, doc long, text_hash long, pos int"
STREAMED = "kind int, h1 long, h2 long, doc long, text_hash long, pos int"
DROP, PENDING, EDGE = 0, 1, 2


def line_rows(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            digests, ids, texts, places = [], [], [], []
            for doc, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:
                    continue
                for pos, line in enumerate(text.split("\n")):
                    key = line.strip(SPACE_CHARS)
                    if len(key) >= min_chars:
                        # bytes.lower() changes A-Z only
                        digests.append(xxhash.xxh3_128_digest(utf8(key).lower()))
                        ids.append(doc)
                        texts.append(text_hash)
                        places.append(pos)
            pairs = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pairs[:, 0], pa.int64()),
                    pa.array(pairs[:, 1], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(texts, pa.int64()),
                    pa.array(places, pa.int32()),
                ],
                names=["h1", "h2", "doc", "text_hash", "pos"],
            )

    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST_ID))).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    return keyed.mapInArrow(hashes, LINES)


def stream_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted line rows of one partition -> lines to drop, lines to settle, edges.

    Only the current hash and its first document are carried from batch to batch.
    """

    def rows(kind: int, h1, h2, doc, text_hash, pos) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(h1), kind, np.int32))]
            + [pa.array(x) for x in (h1, h2, doc, text_hash, pos)],
            names=["kind", "h1", "h2", "doc", "text_hash", "pos"],
        )

    def edge(h1: int, h2: int, doc: int) -> pa.RecordBatch:
        one = lambda x: np.array([x], np.int64)
        return rows(EDGE, one(h1), one(h2), one(doc), one(0), np.zeros(1, np.int32))

    current, leading = None, True  # current: (h1, h2, first document)
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, text_hash, pos = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = current is not None and current[:2] == (h1[0], h2[0])
        new[0] = not goes_on
        if current is not None and not goes_on:
            leading = False  # the leading hash ended with the batch before
        if current is None:
            yield edge(h1[0], h2[0], doc[0])
        group = np.cumsum(new) - (0 if goes_on else 1)
        firsts = doc[new]
        if goes_on:
            firsts = np.concatenate([[current[2]], firsts])
        first = firsts[group]
        in_leading = np.zeros(len(h1), bool)
        if leading:
            in_leading = group == 0
            leading = bool(in_leading[-1])
        for kind, chosen in ((DROP, ~in_leading & (doc != first)), (PENDING, in_leading)):
            if chosen.any():
                yield rows(kind, *(x[chosen] for x in (h1, h2, doc, text_hash, pos)))
        current = (h1[-1], h2[-1], first[-1])
    if current is not None:
        yield edge(*current)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """(doc_id, text_hash, keep): for each document that loses lines, a zlib-compressed
    bitmap with one bit per line up to the last dropped one (1: kept)."""
    lines = stored(line_rows(docs, min_chars), "lines")
    order = ["h1", "h2", "doc", "text_hash", "pos"]
    streamed = stored(
        lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(stream_firsts, STREAMED),
        "line-firsts",
    )
    edges = streamed.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"))
    settled = (
        # edges: at most two rows for each partition of the sort
        streamed.filter(F.col("kind") == PENDING)
        .join(F.broadcast(edges), ["h1", "h2"])
        .filter("doc > first_doc")
        .select("doc", "text_hash", "pos")
    )
    dropped = streamed.filter(F.col("kind") == DROP).select("doc", "text_hash", "pos").unionByName(settled)

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for places in batch.column("places"):
                gone = places.values.to_numpy(zero_copy_only=False)
                keep = np.ones((int(gone.max()) + 8) // 8 * 8, bool)  # whole bytes
                keep[gone] = False
                packed.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array(packed, pa.binary())],
                names=["doc", "text_hash", "keep"],
            )

    return (
        dropped.groupBy("doc", "text_hash")
        .agg(F.collect_set("pos").alias("places"))
        .mapInArrow(bitmaps, "doc long, text_hash long, keep binary")
    )


def kept_lines(text: str | None, keep: bytes | None) -> tuple[str, int, int]:
    """(kept text, lines, dropped lines) of one document and its bitmap."""
    lines = (text or "").split("\n")
    n = len(lines)
    if keep is None:
        return text or "", n, 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    left = [line for i, line in enumerate(lines) if i >= len(bits) or bits[i]]
    return "\n".join(left), n, n - len(left)


def _with_bitmaps(docs: DataFrame, min_chars: int) -> tuple[DataFrame, str]:
    """``docs`` with a bitmap column under a free name."""
    maps = keep_bitmaps(docs, min_chars)
    id_, hash_, keep = (free_name(docs, x) for x in ("line_doc", "line_text_hash", "line_keep"))
    maps = maps.select(F.col("doc").alias(id_), F.col("text_hash").alias(hash_), F.col("keep").alias(keep))
    same = (F.coalesce(docs["doc_id"].cast("long"), F.lit(int(LAST_ID))) == maps[id_]) & (
        F.xxhash64(docs["text"]) == maps[hash_]
    )
    return docs.join(maps, same, "left").drop(id_, hash_), keep


def dedup_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``docs`` with the text of every document cut to its kept lines (same columns;
    a column ``n_chars`` is brought up to date, a null text stays null)."""
    joined, keep = _with_bitmaps(docs, min_chars)
    text_at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts, bits = batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            left = [t if k is None else kept_lines(t, k)[0] for t, k in zip(texts, bits)]
            columns = batch.columns[:-1]
            columns[text_at] = pa.array(left, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    out = joined.select(*docs.columns, keep).mapInArrow(cut, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def line_digest(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = [kept_lines(t, k) for t, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for _, n, _ in out], pa.int64()),
                    pa.array([d for _, _, d in out], pa.int64()),
                    pa.array([hashlib.sha256(utf8(t)).hexdigest() for t, _, _ in out], pa.string()),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined, keep = _with_bitmaps(narrow, min_chars)
    return joined.select("doc_id", "text", keep).mapInArrow(
        digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


# DuckDB's trim() takes the characters to strip; lower-casing of A-Z only is a translate().
ORACLE = """
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), keys AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(l.doc_id > k.first_doc, false) AS gone
  FROM lines l LEFT JOIN keys k ON l.key = k.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
