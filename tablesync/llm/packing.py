"""Best-fit packing: hierarchical residual packing of token pieces into sequences.

1. Every document is tokenised once; only documents longer than the sequence
   length are cut, into full pieces and a last one.
2. Round after round the open items (pieces at first, underfull bins later) are
   dealt over partitions of about ``items_per_task`` items.  Each task packs its
   items best-fit decreasing and emits its bins; nearly full bins are final, the
   underfull ones go into the next round as single items, over fewer partitions.
   The last round has one partition, or is the first that merges no more than the
   share ``1 - worth_it`` of its items (items that cannot share a bin stay spread over
   tasks); with ``worth_it = 1`` rounds go on as long as any two items merge.
3. A bin carries its members (at most one per token), so no join is needed to
   find a piece's place.

Defined results: a null or empty text is the end token alone; a null ``doc_id``
stays null; repeated rows are packed once each; ties are broken by the members
themselves; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table, text_slices, utf8

SEQUENCE_TOKENS = 4096
END_ID = 1
NEARLY_FULL = 4  # tokens a final bin may lack before the last round
ITEMS_PER_TASK = 50_000
WORTH_IT = 1.0  # another round must start with less than this share of the last one's items
CACHE_BYTES = 200 << 20  # of word forms and their ids that a Python worker remembers, about
FORM_BYTES = 170  # of a remembered form besides its letters and ids
MARKS = b".,;:!?"

# Latin letters without those whose lower case or composed form is another matter.
PLAIN = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# How byte-level vocabularies spell a byte: printable Latin-1 as itself, the rest from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}

MEMBER = np.dtype(
    [("doc_id", "<i8"), ("null_id", "u1"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")]
)
PIECES = "size int, members binary"
BINS = "size int, members binary, bin long, open boolean"
PLACES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


class WordEncoder:
    """Token ids of whole texts, by way of the ids of their words.

    The vocabulary's pre-tokenizer never crosses white space and its normaliser
    lower-cases, so a text's ids are its space-separated words' ids in a row.
    Word forms are remembered in two generations of half the bound each: once the
    young one is full it becomes the old one, and what was not asked for since the
    last change is forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.young_bytes = 0

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, then the end token."""
        end = np.array([END_ID], "<u4").tobytes()
        out = []
        for text in texts:
            data = utf8(text)
            # lower-casing must not turn other letters into a special token's name
            words = (data if b"<|" in data else data.lower()).split()
            ids = list(map(self.young.get, words))
            if None in ids:
                fresh = self.recall({w for w, x in zip(words, ids) if x is None})
                ids = [fresh[w] if x is None else x for w, x in zip(words, ids)]
            ids.append(end)
            out.append(b"".join(ids))
        return out

    def remember(self, word: bytes, ids: bytes) -> None:
        self.young[word] = ids
        self.young_bytes += len(word) + len(ids) + FORM_BYTES
        if self.young_bytes > CACHE_BYTES // 2:
            self.old, self.young, self.young_bytes = self.young, {}, 0

    def recall(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not young: the old ones become young, the others are encoded."""
        found = {}
        for w in words:
            ids = self.old.get(w)
            if ids is not None:
                found[w] = ids
        unknown = words - found.keys()
        if unknown:
            found |= self.encode(unknown)
        for w, ids in found.items():
            self.remember(w, ids)
        return found

    def encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not remembered.

        The normaliser and the pre-tokenizer leave a lower-case run of Latin letters
        as it is and cut it from the marks after it, so such a run goes to the model
        at once; everything else goes through the whole tokenizer.
        """
        fresh, others, marked = {}, set(), []
        run_ids = self.run_ids
        for w in words:
            if w.isalpha():  # ASCII letters only
                fresh[w] = run_ids(w.lower())
                continue
            letters = w.rstrip(MARKS)
            if not PLAIN.fullmatch(letters.decode("utf-8", "replace")):
                others.add(w)
            elif len(letters) == len(w):
                fresh[w] = run_ids(letters.decode().lower().encode())
            else:
                marks = w[len(letters) :]
                marked.append((w, letters, marks))
                if marks not in self.young and marks not in self.old:
                    others.add(marks)
        listed = list(others)
        if listed:
            encoded = self.tokenizer.encode_batch_fast(
                [w.decode("utf-8", "replace") for w in listed], add_special_tokens=False
            )
            fresh.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(listed, encoded))
        known = lambda w: self.young.get(w) or self.old.get(w) or fresh.get(w)
        for w, letters, marks in marked:
            run = letters.decode().lower().encode()
            ids = known(run)
            if ids is None:
                ids = fresh[run] = run_ids(run)
            fresh[w] = ids + known(marks)
        return fresh

    def run_ids(self, run: bytes) -> bytes:
        """Ids of a lower-case run of Latin letters."""
        spelled = run.decode() if run.isascii() else "".join(map(BYTE_LETTERS.__getitem__, run))
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str) -> WordEncoder:
    """One encoder a Python worker, kept from task to task.

    This package travels to the workers by value, so the cache has a module of its own there.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    kept = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def token_pieces(docs: DataFrame, vocabulary: str, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of each document's ids: its size and its record."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in text_slices(batches):
            sizes, members = [], []
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                total, view = len(ids) // 4, memoryview(ids)
                for piece, start in enumerate(range(0, total, sequence_tokens)):
                    length = min(sequence_tokens, total - start)
                    crc = zlib.crc32(view[4 * start : 4 * (start + length)])
                    record = (doc or 0, doc is None, piece, start, length, crc)
                    sizes.append(length)
                    members.append(np.array([record], MEMBER).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), pa.array(members, pa.binary())], names=["size", "members"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Best-fit of items in the given order: lists of item positions, one a bin."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(room + 1)]  # bins by room left
    rooms: list[int] = []  # the rooms for which there is a bin, ascending
    for item, size in enumerate(sizes):
        at = bisect_left(rooms, size)
        if at == len(rooms):
            bins.append([item])
            b, left = len(bins) - 1, room - size
        else:
            had = rooms[at]
            b, left = with_room[had].pop(), had - size
            if not with_room[had]:
                rooms.pop(at)
            bins[b].append(item)
        if left > 0:
            if not with_room[left]:
                insort(rooms, left)
            with_room[left].append(b)
    return bins


def pack(
    items: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, items_per_task: int = ITEMS_PER_TASK, worth_it: float = WORTH_IT
) -> DataFrame:
    """(size, members) items -> (size, members, bin): the rounds described above."""

    def packed(round_: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [(s, m) for b in batches for s, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            rows.sort(key=lambda x: (-x[0], x[1]))
            bins = best_fit([s for s, _ in rows], sequence_tokens)
            # unique numbers: round, partition, place in the partition
            first = (round_ << 56) | (TaskContext.get().partitionId() << 28)
            for at in range(0, len(bins), 5000):
                part = bins[at : at + 5000]
                sizes = [sum(rows[i][0] for i in b) for b in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sizes, pa.int32()),
                        pa.array([b"".join(rows[i][1] for i in b) for b in part], pa.binary()),
                        pa.array(range(first + at, first + at + len(part)), pa.int64()),
                        pa.array([not last and s < sequence_tokens - NEARLY_FULL for s in sizes], pa.bool_()),
                    ],
                    names=["size", "members", "bin", "open"],
                )

        return run

    finished, open_, before, round_ = [], stored(items, "pack-items"), None, 0
    while True:
        n = open_.count()
        tasks = max(1, -(-n // items_per_task))
        last = tasks == 1 or (before is not None and n >= worth_it * before)
        dealt = open_.repartition(tasks, F.xxhash64("members", F.lit(round_)))
        bins = stored(dealt.mapInArrow(packed(round_, last), BINS), "pack-bins")
        finished.append(bins.filter("NOT open").select("size", "members", "bin"))
        if last:
            break
        open_, before, round_ = bins.filter("open").select("size", "members"), n, round_ + 1
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def places(bins: DataFrame) -> DataFrame:
    """One row per piece with its sequence and its offset there."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = [np.frombuffer(m, MEMBER) for m in batch.column("members").to_pylist()]
            if not records:
                continue
            r = np.concatenate(records)
            offsets = np.concatenate([np.cumsum(x["length"], dtype=np.int64) - x["length"] for x in records])
            bins_ = np.repeat(batch.column("bin").to_numpy(), [len(x) for x in records])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(r["doc_id"], pa.int64(), mask=r["null_id"].astype(bool)),
                    pa.array(r["piece"], pa.int32()),
                    pa.array(r["start"], pa.int64()),
                    pa.array(r["length"].astype(np.int64)),
                    pa.array(r["crc"].astype(np.int64)),
                    pa.array(bins_, pa.int64()),
                    pa.array(offsets),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return bins.mapInArrow(expand, PLACES)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Tokenise and pack ``docs``; ``vocabulary`` is a tokenizers file every executor can read."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return places(pack(token_pieces(docs, vocabulary, sequence_tokens), sequence_tokens))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
