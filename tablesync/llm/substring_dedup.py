"""Substring dedup: windows of words counted exactly in super-k-mer buckets.

* Documents are dealt over *blocks* of a few megabytes by a hash of the row, so a
  block's content does not depend on how the input was split.
* Within a block, consecutive windows that share a minimiser (the smallest hash
  among the window's 3-grams of words) form one super-k-mer.  Equal super-k-mers
  of a block become one packed string with the smallest ``doc_id`` that holds it:
  a passage repeated through a third of the corpus travels once a block.
* The packed strings of a block travel to the buckets of their minimisers, where
  the windows are sorted by hash, verified byte by byte, and the smallest document
  of each window is found.  Only windows that start in a smaller document than the
  block knows of are sent back, to the block.
* The block, built again from the same rows, marks and removes the covered words.

3-grams of short words are the smallest only where a window has no other; such a
window is its own key, so that no few common words attract a whole bucket.  So is a
window whose minimiser alone would fill a bucket: the packed bytes of every minimiser
are summed over some blocks first.  Equal windows have the same minimiser and hence
the same key, whichever minimisers are found heavy.

Defined results: a null or empty text has no words; a null ``doc_id`` sorts after
all others and counts as one document; rows with the same ``doc_id`` do not remove
words from one another; repeated rows get equal results; a document shorter than a
window is kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import table, utf8

WINDOW = 13
GRAM = 3  # words of a minimiser
SHORT = 4  # letters up to which a word counts as common
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
FEWEST = 64  # blocks and buckets, however small the input
WEIGHED = 32  # blocks whose super-k-mers are weighed for heavy minimisers
LAST_ID = np.iinfo(np.int64).max

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
TOP = U(1 << 63)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the polynomial's low bits are weak)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    if n:
        out[0] = U(1)
    return np.multiply.accumulate(out)


class Spans:
    """A byte string of words, each followed by one space, with hashes of any span."""

    def __init__(self, text: bytes):
        self.bytes = np.frombuffer(text, np.uint8)
        self.ends = np.flatnonzero(self.bytes == 32)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        sums = np.zeros(len(text) + 1, U)
        np.cumsum(self.bytes * powers(BASE, len(text)), out=sums[1:])
        self.at_start, self.at_end = sums[self.starts], sums[self.ends]
        self.shift = powers(BASE_INVERSE, len(text))[self.starts]

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the text from word ``first`` to word ``last``, both included."""
        return mix((self.at_end[last] - self.at_start[first]) * self.shift[first])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


NO_KEYS = np.zeros(0, U)


class Block:
    """The super-k-mers of some documents, equal ones merged; windows of ``heavy``
    minimisers are keys of their own."""

    def __init__(self, ids: np.ndarray, texts: list[str | None], window: int, buckets: int, heavy: np.ndarray = NO_KEYS):
        self.words = [utf8(t).split() for t in texts]
        counts = np.array([len(w) for w in self.words], np.int64)
        self.first_word = np.concatenate([[0], np.cumsum(counts)])
        text = b"".join(b" ".join(w) + b" " for w in self.words if w)
        self.size = int(self.first_word[-1])
        self.run_window = self.run_length = self.run_doc = self.run_entry = np.zeros(0, np.int64)
        self.entry_bucket, self.entry_doc, self.entry_text = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        self.entry_key = NO_KEYS
        per_doc = np.maximum(counts - window + 1, 0)
        if not per_doc.sum():
            return
        spans = Spans(text)
        gram = min(GRAM, window)
        at = np.arange(self.size - gram + 1)
        values = spans.hashes(at, at + gram - 1)
        long_word = spans.ends - spans.starts > SHORT
        has_long = np.zeros(len(at), bool)
        for k in range(gram):
            has_long |= long_word[k : k + len(at)]
        values = np.where(has_long, values & ~TOP, values | TOP)
        # windows: all positions whose words belong to one document
        doc = np.repeat(np.arange(len(counts)), per_doc)
        windows = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc) + self.first_word[doc]
        key = sliding_min(values, window - gram + 1)[windows]
        own = (key >= TOP) | np.isin(key, heavy)
        if own.any():
            key[own] = spans.hashes(windows[own], windows[own] + window - 1) | TOP
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        begins = np.flatnonzero(new)
        length = np.diff(np.append(begins, len(key)))
        first, doc, key = windows[begins], doc[begins], key[begins]
        last = first + length - 1 + window - 1
        bucket = (key % U(buckets)).astype(np.int64)
        whole = spans.hashes(first, last)
        order = np.lexsort((ids[doc], last - first, whole, key, bucket))
        first, last, doc, key, whole, length, bucket = (
            x[order] for x in (first, last, doc, key, whole, length, bucket)
        )
        starts, ends = spans.starts[first], spans.ends[last]
        size = ends - starts
        same = np.zeros(len(first), bool)
        same[1:] = (whole[1:] == whole[:-1]) & (key[1:] == key[:-1]) & (size[1:] == size[:-1])
        for k in np.flatnonzero(same):  # equal hashes are taken for equal only with equal bytes
            same[k] = text[starts[k] : ends[k]] == text[starts[k - 1] : ends[k - 1]]
        self.run_window, self.run_length, self.run_doc = first, length, doc
        self.run_entry = np.cumsum(~same) - 1
        entry = np.flatnonzero(~same)
        self.entry_key = key[entry]
        self.entry_bucket, self.entry_doc = bucket[entry], ids[doc[entry]]  # sorted by id: the smallest
        self.entry_text = [text[s:e] for s, e in zip(starts[entry].tolist(), ends[entry].tolist())]

    def by_bucket(self):
        """(bucket, first entry, end) of each bucket that has entries."""
        if not len(self.entry_bucket):
            return
        cuts = np.flatnonzero(np.diff(self.entry_bucket)) + 1
        for a, b in zip(np.concatenate([[0], cuts]), np.append(cuts, len(self.entry_bucket))):
            yield int(self.entry_bucket[a]), int(a), int(b)


def equal_text(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` (8 at least) bytes at ``a`` and at ``b`` are the same."""
    eights = np.ndarray((len(text) - 7,), "<u8", text.data, strides=(1,))
    same = eights[a + size - 8] == eights[b + size - 8]
    for k in range(0, int(size.max(initial=0)) - 7, 8):
        live = np.flatnonzero(same & (size >= k + 8))
        same[live] = eights[a[live] + k] == eights[b[live] + k]
    return same


def first_documents(entries: list[bytes], docs: np.ndarray, window: int):
    """Windows of the entries that start in a smaller document than their entry's.

    -> (entry, window's place in it, smallest document), three arrays.
    """
    text = b"".join(e + b" " for e in entries)
    spans = Spans(text)
    entry_end = np.cumsum([len(e) + 1 for e in entries])
    n_words = np.diff(np.searchsorted(spans.ends, entry_end), prepend=0)
    per_entry = n_words - window + 1
    entry = np.repeat(np.arange(len(entries)), per_entry)
    place = np.arange(len(entry)) - np.repeat(np.cumsum(per_entry) - per_entry, per_entry)
    first = place + (np.cumsum(n_words) - n_words)[entry]
    start, size = spans.starts[first], spans.ends[first + window - 1] - spans.starts[first]
    value = spans.hashes(first, first + window - 1)
    order = np.argsort(value, kind="stable")
    sorted_value = value[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_value[1:] != sorted_value[:-1]
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    order, group = order[several], group[several]
    if not len(order):
        none = np.zeros(0, np.int64)
        return none, none, none
    head = order[np.concatenate([[True], group[1:] != group[:-1]])]
    head = head[np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1]
    same = size[order] == size[head]
    pad = np.zeros(8, np.uint8)
    padded = np.concatenate([spans.bytes, pad])
    if window >= 5:  # five words and their spaces have nine bytes at least
        same[same] = equal_text(padded, start[order[same]], start[head[same]], size[order[same]])
    else:
        same[same] = False
    if not same.all():  # a hash shared by different windows: settle those by their text
        exact: dict[bytes, int] = {}
        next_group = int(group[-1]) + 1
        for k in np.flatnonzero(np.isin(group, group[~same])):
            s = start[order[k]]
            group[k] = exact.setdefault(text[s : s + size[order[k]]], next_group + len(exact))
        resort = np.argsort(group, kind="stable")
        order, group = order[resort], group[resort]
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    smallest = np.minimum.reduceat(docs[entry[order]], begins)
    smallest = np.repeat(smallest, np.diff(np.append(begins, len(group))))
    tell = smallest < docs[entry[order]]
    return entry[order][tell], place[order][tell], smallest[tell]


def sealed(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays packed and compressed; :func:`opened` reads them back."""
    raw = [np.ascontiguousarray(a).tobytes() if isinstance(a, np.ndarray) else a for a in arrays]
    head = np.array([len(r) for r in raw], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def opened(blob: bytes, parts: int) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw[: 8 * parts], "<i8")
    ends = 8 * parts + np.cumsum(sizes)
    return [raw[e - s : e] for s, e in zip(sizes, ends)]


def _block_of(part: pa.Table, window: int, buckets: int, heavy: np.ndarray = NO_KEYS) -> tuple[Block, np.ndarray, pa.Table]:
    """The block's rows in an order of their own, and its super-k-mers."""
    part = part.sort_by([("doc", "ascending"), ("text_hash", "ascending")]).combine_chunks()
    ids = part.column("doc").to_numpy()
    return Block(ids, part.column("text").to_pylist(), window, buckets, heavy), ids, part


def heavy_keys(dealt: DataFrame, blocks: int, window: int, most: int) -> tuple[np.ndarray, int]:
    """Minimisers with more than about ``most`` packed bytes, sorted, and those bytes.

    The sums are taken over WEIGHED blocks (all, if there are no more) and scaled up;
    documents are dealt to the blocks by hash.  A block tells a minimiser only where it
    has half its share of ``most`` there, so a heavy one misses half its bytes at most.
    """
    weighed = min(blocks, WEIGHED)
    told = most / blocks / 2

    def weigh(key, part):
        block, _, _ = _block_of(part, window, 1)
        keys, at = np.unique(block.entry_key, return_inverse=True)
        sizes = np.bincount(at, weights=[len(t) for t in block.entry_text], minlength=len(keys))
        chosen = (keys < TOP) & (sizes > told)
        return pa.table({"key": pa.array(keys[chosen].astype(np.int64)), "size": pa.array(sizes[chosen].astype(np.int64))})

    found = (
        dealt.filter(F.col("block") < weighed)
        .groupBy("block")
        .applyInArrow(weigh, "key long, size long")
        .groupBy("key")
        .agg(F.sum("size").alias("size"))
        .filter(F.col("size") > told * weighed)
        .collect()  # about twice as many as there are buckets at most
    )
    bytes_ = sum(r["size"] for r in found) * blocks // weighed
    return np.sort(np.array([r["key"] for r in found], np.int64)).astype(U), bytes_


def _removed(block: Block, ids: np.ndarray, replies: pa.Table, window: int) -> np.ndarray:
    """For each word of the block whether a removed window covers it."""
    gone = np.zeros(block.size + window + 1, np.int64)

    def remove(first: np.ndarray) -> None:
        np.add.at(gone, first, 1)
        np.add.at(gone, first + window, -1)

    # what the block knows by itself: the run's document is not its entry's smallest
    local = ids[block.run_doc] > block.entry_doc[block.run_entry] if len(block.run_entry) else np.zeros(0, bool)
    begin, length = block.run_window[local], block.run_length[local]
    np.add.at(gone, begin, 1)
    np.add.at(gone, begin + length - 1 + window, -1)
    # what the buckets say
    first_entry = {bucket: a for bucket, a, _ in block.by_bucket()}
    runs = np.bincount(block.run_entry, minlength=len(block.entry_doc)) if len(block.entry_doc) else None
    first_run = np.cumsum(runs) - runs if runs is not None else None
    for bucket, blob in zip(replies.column("bucket").to_pylist(), replies.column("blob").to_pylist()):
        entry, place, smallest = (np.frombuffer(x, t) for x, t in zip(opened(blob, 3), ("<i4", "<i4", "<i8")))
        entry = entry.astype(np.int64) + first_entry[bucket]
        n = runs[entry]
        run = np.repeat(first_run[entry] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        later = ids[block.run_doc[run]] > np.repeat(smallest, n)
        remove((block.run_window[run] + np.repeat(place, n))[later])
    return np.cumsum(gone)[: block.size] > 0


def _dedup(docs: DataFrame, window: int, finish, schema: str) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST_ID))).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(FEWEST, -(-total // BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc", "text_hash"), F.lit(blocks)))
    heavy, heavy_bytes = heavy_keys(dealt, blocks, window, BUCKET_BYTES)
    # a super-k-mer has about three times its windows' share of words; single windows have up to about six times its words
    buckets = max(FEWEST, -(-(3 * total + 6 * heavy_bytes) // BUCKET_BYTES))

    def send(key, part):
        block, _, _ = _block_of(part, window, buckets, heavy)
        bucket, blobs = [], []
        for b, first, end in block.by_bucket():
            texts = block.entry_text[first:end]
            sizes = np.array([len(t) for t in texts], "<i4")
            bucket.append(b)
            blobs.append(sealed(sizes, block.entry_doc[first:end], b"".join(texts)))
        return pa.table(
            {
                "bucket": pa.array(bucket, pa.int64()),
                "block": pa.array([key[0].as_py()] * len(bucket), pa.int64()),
                "blob": pa.array(blobs, pa.binary()),
            }
        )

    def count(key, part):
        entries, docs_, row = [], [], []
        for k, blob in enumerate(part.column("blob").to_pylist()):
            sizes, smallest, text = opened(blob, 3)
            ends = np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
            entries.extend(text[a:b] for a, b in zip([0, *ends], ends))
            docs_.append(np.frombuffer(smallest, "<i8"))
            row.append(np.full(len(ends), k))
        first = np.concatenate([[0], np.cumsum([len(x) for x in row])])
        entry, place, smallest = first_documents(entries, np.concatenate(docs_), window)
        row = np.concatenate(row)[entry]
        order = np.argsort(row, kind="stable")
        entry, place, smallest, row = entry[order], place[order], smallest[order], row[order]
        cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
        told = [k for k in range(part.num_rows) if cuts[k] < cuts[k + 1]]
        blobs = [
            sealed(
                (entry[a:b] - first[k]).astype("<i4"), place[a:b].astype("<i4"), smallest[a:b].astype("<i8")
            )
            for k, a, b in ((k, cuts[k], cuts[k + 1]) for k in told)
        ]
        return pa.table(
            {
                "block": part.column("block").combine_chunks().take(pa.array(told, pa.int64())),
                "bucket": pa.array([key[0].as_py()] * len(told), pa.int64()),
                "blob": pa.array(blobs, pa.binary()),
            }
        )

    def rebuild(part, replies):
        block, ids, part = _block_of(part, window, buckets, heavy)
        gone = _removed(block, ids, replies, window)
        n_removed, kept = [], []
        for k, words in enumerate(block.words):
            mine = gone[block.first_word[k] : block.first_word[k + 1]]
            n_removed.append(int(mine.sum()))
            kept.append(b" ".join(compress(words, ~mine) if n_removed[-1] else words))
        return pa.table(
            {
                "doc_id": part.column("doc_id"),
                "n_words": pa.array([len(w) for w in block.words], pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                **finish(kept),
            }
        )

    sent = dealt.groupBy("block").applyInArrow(send, "bucket long, block long, blob binary")
    replies = sent.groupBy("bucket").applyInArrow(count, "block long, bucket long, blob binary")
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        rebuild, f"doc_id long, n_words long, n_removed long, {schema}"
    )


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the words left, joined by one space."""
    return _dedup(
        docs, window, lambda kept: {"kept": pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())}, "kept string"
    )


def substring_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The same with a digest of the kept words instead of the text."""
    return _dedup(
        docs,
        window,
        lambda kept: {"kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())},
        "kept_sha256 string",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), firsts AS (
  SELECT k, min(doc_id) AS first_doc FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, i + o AS p
  FROM (SELECT doc_id, i, unnest(range(0, 13)) AS o FROM windows JOIN firsts USING (k) WHERE first_doc < doc_id)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT w.doc_id, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (g.p IS NULL) AS text
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY w.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
