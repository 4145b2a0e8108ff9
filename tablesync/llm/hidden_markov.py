"""Language-model scoring by a hidden Markov model.

Latent states emit word *classes*, and a class emits its words:

* A word with at least one ``HEAD_WORDS``-th of all training tokens is a class of its own
  (so there are at most ``HEAD_WORDS`` of them, however large the corpus), and so is the
  end of a text.  Every other word, known or not, belongs to one of ``TAIL_CLASSES``
  classes by its spelling.
* Inside a tail class a known word has its exact share of the class's training tokens.
  The class also holds one event for the words that training did not see, as likely as
  the words that it saw once, plus one (so the classes' events sum to one).
* Transitions, first states and P(class | state) come from Baum-Welch: every iteration runs
  scaled forward and backward recursions over *all* training texts in the partitions, adds
  up the expected counts by class there, and sums them across partitions; the driver holds
  the model (at most ``(HEAD_WORDS + TAIL_CLASSES + 1) * STATES`` numbers), nothing else.
  No iteration reads less.  The states begin with emissions drawn far apart, from which
  few iterations do.

The score is log10 of the probability of the text's tokens with their end, by the scaled
forward recursion over the whole text, exact but for rounding.

How it is laid out: the texts are read once, into *blocks* of about ``BLOCK_TOKENS`` tokens
that hold their distinct words once and the texts as numbers.  The blocks' words meet in
buckets by their hash, where they are counted over the corpus; every block gets back the
counts of its own words.  The distinct words of a block travel, not its tokens, and a
word that makes up a third of the corpus is one entry a block.  All later passes read the
blocks as class numbers.  In a block all texts step through the recursion together; a
block of more tokens than ``HELD_TOKENS`` (one very long text) keeps a state vector per
stretch and repeats the stretches on the way back, so memory stays bounded.

Defined results: a null text is empty, and an empty text is the end token alone; a null
``doc_id`` reads as an empty text in the hash and stays null in the result; repeated rows
are texts of their own; with no training text every count is zero; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table, text_slices, utf8

HELD_OUT = (7, 2)  # texts whose hash leaves this remainder are not learned from
STATES = 8
ITERATIONS = 6  # each over all training texts
HEAD_WORDS = 10_000
TAIL_CLASSES = 1_000
SUFFIX = 3  # bytes at a word's end that choose its tail class
BLOCK_TOKENS = 1 << 20
HELD_TOKENS = 1 << 21
BUCKET_WORDS = 500_000  # words of blocks, about, that meet in one bucket
SMOOTHING = 20.0  # tokens' worth of the corpus's own class shares in every state

BLOCKS = (
    "block long, words binary, train_counts binary, low binary, high binary, "
    "doc_ids array<long>, lengths array<int>, held array<boolean>, n_words long, train_tokens long, train_docs long"
)
ENTRIES = "bucket int, block long, ids binary, words binary, train_counts binary"
COUNTED = (
    "bucket int, block long, ids binary, counts binary, classes binary, "
    "n_words long, head_counts array<long>, tail_tokens array<long>, tail_words array<long>, tail_singles array<long>"
)
NUMBERED = (
    "block long, doc_ids array<long>, lengths array<int>, held array<boolean>, classes binary, "
    "n_known array<long>, base array<double>, inside array<double>"
)
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def is_held_out(doc: int | None) -> bool:
    parts, remainder = HELD_OUT
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % parts == remainder


def text_blocks(docs: DataFrame) -> DataFrame:
    """The texts as numbers, in blocks that hold their distinct words."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        first = TaskContext.get().partitionId() << 32

        def block(number, texts, ids, held) -> pa.RecordBatch:
            nonlocal made
            tokens = np.concatenate(texts) if texts else np.empty(0, np.int64)
            lengths = [len(t) for t in texts]
            learned = tokens[np.repeat(~np.array(held, bool), lengths)]
            made += 1
            columns = [
                [first + made - 1],
                [b" ".join(number)],
                [np.bincount(learned, minlength=len(number)).astype("<u4").tobytes()],
                [(tokens & 0xFFFF).astype("<u2").tobytes()],
                [(tokens >> 16).astype("<u2").tobytes()],
                [ids],
                [lengths],
                [held],
                [len(number)],
                [len(learned) + held.count(False)],
                [held.count(False)],
            ]
            kinds = [
                pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
                pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int64(), pa.int64(), pa.int64(),
            ]
            names = [x.split()[0] for x in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        number, texts, ids, held, size = defaultdict(count().__next__), [], [], [], 0
        for batch in text_slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = utf8(text).lower().split()
                texts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                ids.append(doc)
                held.append(is_held_out(doc))
                size += len(words) + 1
                if size >= BLOCK_TOKENS:
                    yield block(number, texts, ids, held)
                    number, texts, ids, held, size = defaultdict(count().__next__), [], [], [], 0
        if ids:
            yield block(number, texts, ids, held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, BLOCKS)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % TAIL_CLASSES


def split_words(data: bytes) -> list[bytes]:
    return data.split(b" ") if data else []


def counted_words(blocks: DataFrame, train_tokens: int, buckets: int) -> DataFrame:
    """Per (block, bucket) the corpus counts and classes of the block's words there;
    per bucket (block null) what it adds to the corpus's statistics."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                words = split_words(words)
                counts = np.frombuffer(counts, "<u4")
                bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
                order = np.argsort(bucket, kind="stable")
                bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = [k for k in range(buckets) if bounds[k] < bounds[k + 1]]
                parts = [order[bounds[k] : bounds[k + 1]] for k in used]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int32()),
                        pa.array([block] * len(used), pa.int64()),
                        pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()),
                        pa.array([b" ".join([words[i] for i in p]) for p in parts], pa.binary()),
                        pa.array([counts[p].tobytes() for p in parts], pa.binary()),
                    ],
                    names=["bucket", "block", "ids", "words", "train_counts"],
                )

    def add_up(group: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        for words, counts in zip(group.column("words").to_pylist(), group.column("train_counts").to_pylist()):
            for w, n in zip(split_words(words), np.frombuffer(counts, "<u4").tolist()):
                total[w] = total.get(w, 0) + n
        head = sorted(w for w, n in total.items() if n and n * HEAD_WORDS >= train_tokens)
        classes = {w: -1 - k for k, w in enumerate(head)}  # numbered over the corpus later
        tails = np.zeros((3, TAIL_CLASSES), np.int64)  # tokens, words, words seen once
        for w, n in total.items():
            if w not in classes:
                k = classes[w] = tail_class(w)
                if n:
                    tails[:, k] += (n, 1, n == 1)
        out = []
        bucket = group.column("bucket")[0].as_py()
        for block, ids, words in zip(*(group.column(c).to_pylist() for c in ("block", "ids", "words"))):
            words = split_words(words)
            c = np.fromiter(map(total.__getitem__, words), "<i8", len(words)).tobytes()
            k = np.fromiter(map(classes.__getitem__, words), "<i4", len(words)).tobytes()
            out.append((bucket, block, ids, c, k, *[None] * 5))
        known = sum(n > 0 for n in total.values())
        out.append((bucket, *[None] * 4, known, [total[w] for w in head], *tails.tolist()))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 3, pa.int64(), *[pa.list_(pa.int64())] * 4]
        names = [x.split()[0] for x in COUNTED.split(", ")]
        return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    entries = blocks.select("block", "words", "train_counts").mapInArrow(deal, ENTRIES)
    return entries.groupBy("bucket").applyInArrow(add_up, COUNTED)


class Corpus:
    """What the driver knows of the corpus: its sizes and the counts of its classes."""

    def __init__(self, counted: DataFrame, train_tokens: int, train_docs: int):
        sums = counted.filter("block IS NULL")
        words = sums.agg(F.sum("n_words")).first()[0] or 0
        self.train_tokens, self.train_docs = train_tokens, train_docs
        self.words = words + (train_docs > 0)  # the end is one
        self.tails = np.zeros((3, TAIL_CLASSES), np.int64)  # tokens, words, words seen once
        zipped = F.posexplode(F.arrays_zip("tail_tokens", "tail_words", "tail_singles"))
        for r in (
            sums.select(zipped)
            .groupBy("pos")
            .agg(*(F.sum(f"col.{c}").alias(c) for c in ("tail_tokens", "tail_words", "tail_singles")))
            .collect()
        ):
            self.tails[:, r.pos] = r[1:]
        # at most HEAD_WORDS words in all, so at most as many rows
        self.first_head: dict[int, int] = {}
        tokens = list(self.tails[0])
        for r in sums.filter("size(head_counts) > 0").select("bucket", "head_counts").orderBy("bucket").collect():
            self.first_head[r.bucket] = len(tokens)
            tokens += r.head_counts
        self.end = len(tokens)
        tokens = np.array([*tokens, train_docs], float)
        self.shares = (tokens + 1) / (tokens.sum() + len(tokens))


def numbered_blocks(blocks: DataFrame, counted: DataFrame, corpus: Corpus) -> DataFrame:
    """The blocks' texts as class numbers (ends included), with what needs no hidden state."""
    unseen = np.append(corpus.tails[2] + 1.0, np.ones(corpus.end + 1 - TAIL_CLASSES))
    in_class = np.append(corpus.tails[0] + corpus.tails[2] + 1.0, np.ones(corpus.end + 1 - TAIL_CLASSES))
    first_head, end, train_docs = corpus.first_head, corpus.end, corpus.train_docs
    all_words = float(corpus.train_tokens + corpus.words + 1)

    def put_together(block: pa.Table, counted: pa.Table) -> pa.Table:
        b = {c: block.column(c)[0].as_py() for c in block.column_names}
        counts = np.zeros(b["n_words"], np.int64)
        classes = np.zeros(b["n_words"], np.int64)
        for bucket, ids, c, k in zip(*(counted.column(x).to_pylist() for x in ("bucket", "ids", "counts", "classes"))):
            ids, k = np.frombuffer(ids, "<u4"), np.frombuffer(k, "<i4").astype(np.int64)
            counts[ids] = np.frombuffer(c, "<i8")
            classes[ids] = np.where(k < 0, first_head.get(bucket, 0) - 1 - k, k)
        tail = classes < TAIL_CLASSES
        share = np.where(tail, np.where(counts > 0, counts, unseen[classes]) / in_class[classes], 1.0)
        lengths = np.array(b["lengths"], np.int64)
        tokens = np.frombuffer(b["low"], "<u2").astype(np.int64) | (np.frombuffer(b["high"], "<u2").astype(np.int64) << 16)
        text = np.repeat(np.arange(len(lengths)), lengths)
        over = lambda per_word: np.bincount(text, per_word[tokens], len(lengths))
        known = over((counts > 0).astype(float)).astype(np.int64) + (train_docs > 0)
        base = over(np.log10(counts + 1.0)) + np.log10(train_docs + 1.0) - (lengths + 1) * np.log10(all_words)
        inside = over(np.log10(share))
        with_ends = np.insert(classes[tokens], np.cumsum(lengths), end)
        return pa.table(
            [
                pa.array([b["block"]], pa.int64()),
                pa.array([b["doc_ids"]], pa.list_(pa.int64())),
                pa.array([(lengths + 1).tolist()], pa.list_(pa.int32())),
                pa.array([b["held"]], pa.list_(pa.bool_())),
                pa.array([with_ends.astype("<u2").tobytes()], pa.binary()),
                pa.array([known.tolist()], pa.list_(pa.int64())),
                pa.array([base.tolist()], pa.list_(pa.float64())),
                pa.array([inside.tolist()], pa.list_(pa.float64())),
            ],
            names=[x.split()[0] for x in NUMBERED.split(", ")],
        )

    mine = blocks.select("block", "low", "high", "doc_ids", "lengths", "held", "n_words")
    theirs = counted.filter("block IS NOT NULL").select("block", "bucket", "ids", "counts", "classes")
    return mine.groupBy("block").cogroup(theirs.groupBy("block")).applyInArrow(put_together, NUMBERED)


class Steps:
    """Texts of a block laid out by step: first the texts' first tokens, then their second ones, ..."""

    def __init__(self, classes: np.ndarray, lengths: np.ndarray, chosen: np.ndarray):
        starts = np.cumsum(lengths) - lengths
        self.order = chosen[np.argsort(-lengths[chosen], kind="stable")]  # longest first
        sizes = lengths[self.order]
        steps = int(sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts longer than t
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # in the text
        rank = np.repeat(np.arange(len(sizes)), sizes)
        self.classes = np.empty(len(place), np.int64)
        self.rank = np.empty(len(place), np.int32)
        to = self.offsets[place] + rank
        self.classes[to] = classes[np.repeat(starts[self.order], sizes) + place]
        self.rank[to] = rank

    def stretches(self, held_tokens: int) -> list[tuple[int, int]]:
        """Ranges of steps of about ``held_tokens`` tokens at most."""
        cuts, t = [], 0
        while t < len(self.active):
            until = max(t + 1, int(np.searchsorted(self.offsets, self.offsets[t] + held_tokens, side="right")) - 1)
            cuts.append((t, min(until, len(self.active))))
            t = cuts[-1][1]
        return cuts


class Model:
    """First states, transitions and class-major emissions."""

    def __init__(self, first: np.ndarray, moves: np.ndarray, emits: np.ndarray):
        self.first, self.moves, self.emits = first, moves, emits

    @classmethod
    def start(cls, shares: np.ndarray, states: int) -> Model:
        noise = np.random.default_rng(1).exponential(size=(len(shares), states))
        emits = shares[:, None] * (0.1 + noise)
        moves = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1.0 / states), moves, emits / emits.sum(0))

    def forward(self, steps: Steps, t0: int, t1: int, before: np.ndarray | None, emitted: np.ndarray, keep: bool):
        """Scaled forward vectors of the steps t0 to t1: (all of them or the last, scales)."""
        base = steps.offsets[t0]
        out = np.empty_like(emitted) if keep else None
        scales = np.empty(len(emitted), emitted.dtype)
        first, moves = self.first.astype(emitted.dtype), self.moves.astype(emitted.dtype)
        ones = np.ones(len(first), emitted.dtype)
        a = before
        for t in range(t0, t1):
            m, o = steps.active[t], steps.offsets[t] - base
            e = emitted[o : o + m]
            now = out[o : o + m] if keep else np.empty_like(e)
            if t:
                np.matmul(a[:m], moves, out=now)
                now *= e
            else:
                np.multiply(e, first, out=now)
            s = scales[o : o + m]
            np.dot(now, ones, out=s)
            now /= s[:, None]
            a = now
        return (out if keep else a), scales

    def expected(self, steps: Steps, dtype=np.float32) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of first states, moves and emissions, and log10 of the texts' class likelihood."""
        n = len(self.first)
        first, moved, emitted_ = np.zeros(n), np.zeros((n, n)), np.zeros(self.emits.shape)
        total, emits = 0.0, self.emits.astype(dtype)
        back = np.ascontiguousarray(self.moves.T.astype(dtype))
        cuts = steps.stretches(HELD_TOKENS)
        befores = [None]
        for t0, t1 in cuts[:-1]:
            e = emits[steps.classes[steps.offsets[t0] : steps.offsets[t1]]]
            befores.append(self.forward(steps, t0, t1, befores[-1], e, keep=False)[0])
        later = None  # of the step after: emission times backward vector over scale
        for (t0, t1), before in zip(reversed(cuts), reversed(befores)):
            base, active = steps.offsets[t0], steps.active[t0:t1]
            classes = steps.classes[base : steps.offsets[t1]]
            e = emits[classes]
            a, scales = self.forward(steps, t0, t1, before, e, keep=True)
            total += float(np.log10(scales.astype(float)).sum())
            weights = e / scales[:, None]  # times the backward vector, which is one at a text's end
            if later is not None:
                moved += a[len(a) - active[-1] :][: len(later)].T @ later
            for t in range(t1 - 1, t0 - 1, -1):
                o = steps.offsets[t] - base
                now = weights[o : o + steps.active[t]]
                if later is not None:
                    now[: len(later)] *= later @ back
                later = now
            # rows of the second step on, and the rows of the same texts one step before
            second = int(active[0]) if len(active) else 0
            one_before = np.arange(second, len(a)) - np.repeat(active[:-1], active[1:])
            moved += a[one_before].T @ weights[second:]
            a *= weights
            a *= scales[:, None]
            a /= e  # forward times backward vectors
            if t0 == 0 and len(active):
                first += a[:second].sum(0)
            for k in range(n):
                emitted_[:, k] += np.bincount(classes, a[:, k], len(emitted_))
        return first, moved * self.moves, emitted_, total

    def log_likelihoods(self, steps: Steps) -> np.ndarray:
        """log10 of the class likelihood of each text, in the order of ``steps``."""
        out, before = np.zeros(len(steps.order)), None
        for t0, t1 in steps.stretches(HELD_TOKENS):
            at = slice(steps.offsets[t0], steps.offsets[t1])
            before, scales = self.forward(steps, t0, t1, before, self.emits[steps.classes[at]], keep=False)
            out += np.bincount(steps.rank[at], np.log10(scales), len(out))
        return out

    def improved(self, first: np.ndarray, moved: np.ndarray, emitted: np.ndarray, shares: np.ndarray) -> Model:
        first, moved = first + 1.0, moved + 1.0
        emitted = emitted + SMOOTHING * shares[:, None]
        return Model(first / first.sum(), moved / moved.sum(1, keepdims=True), emitted / emitted.sum(0))


def steps_of(row: dict, held: bool | None) -> Steps:
    lengths = np.array(row["lengths"], np.int64)
    chosen = np.arange(len(lengths)) if held is None else np.flatnonzero(np.array(row["held"], bool) == held)
    return Steps(np.frombuffer(row["classes"], "<u2").astype(np.int64), lengths, chosen)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def expected_counts(texts: DataFrame, model: Model) -> DataFrame:
    """(class, e0, e1, ...): a class's expected emissions by state; below the classes'
    numbers come first states (-1), the rows of the moves (-2 - state) and the likelihood."""
    n = len(model.first)
    names = [f"e{k}" for k in range(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for row in block_rows(batches):
            found = model.expected(steps_of(row, held=False))
            sums = list(found) if sums is None else [x + y for x, y in zip(sums, found)]
        if sums is None:
            return
        first, moved, emitted, total = sums
        used = np.flatnonzero(emitted.any(1))
        numbers = np.concatenate([[-2 - n], -2 - np.arange(n), [-1], used])
        values = np.vstack([np.append(total, np.zeros(n - 1)), moved, first, emitted[used]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), *(pa.array(values[:, k]) for k in range(n))], ["class", *names]
        )

    schema = "class long, " + ", ".join(f"{x} double" for x in names)
    sums = texts.select("lengths", "held", "classes").mapInArrow(run, schema)
    return sums.groupBy("class").agg(*(F.sum(x).alias(x) for x in names))


def improved(texts: DataFrame, model: Model, shares: np.ndarray) -> Model:
    """One Baum-Welch iteration over the training texts of some blocks."""
    states = len(model.first)
    first, moved, emitted = np.zeros(states), np.zeros((states, states)), np.zeros((len(shares), states))
    for r in expected_counts(texts, model).collect():  # a row a class at most
        if r[0] >= 0:
            emitted[r[0]] = r[1:]
        elif r[0] == -1:
            first[:] = r[1:]
        elif r[0] >= -1 - states:
            moved[-2 - r[0]] = r[1:]
    return model.improved(first, moved, emitted, shares)


def train(texts: DataFrame, shares: np.ndarray, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch: every iteration runs over all training texts of the numbered blocks."""
    model = Model.start(shares, states)
    for _ in range(iterations):
        model = improved(texts, model, shares)
    return model


def scores(texts: DataFrame, model: Model, train_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in block_rows(batches):
            steps = steps_of(row, held=None)
            likelihood = np.empty(len(steps.order))
            likelihood[steps.order] = model.log_likelihoods(steps)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["held"], pa.bool_()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(row["n_known"], pa.int64()),
                    pa.array([train_tokens] * len(likelihood), pa.int64()),
                    pa.array(row["base"], pa.float64()),
                    pa.array(likelihood + np.array(row["inside"], float)),
                ],
                names=[x.split()[0] for x in SCORES.split(", ")],
            )

    return texts.drop("block").mapInArrow(run, SCORES)


def score_texts(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    assert TAIL_CLASSES + HEAD_WORDS < 1 << 16  # classes are stored in two bytes
    blocks = stored(text_blocks(docs), "lm-blocks")
    sizes = blocks.agg(F.sum("train_tokens"), F.sum("train_docs"), F.sum("n_words")).first()
    train_tokens, train_docs, entries = (x or 0 for x in sizes)
    buckets = max(1, -(-entries // BUCKET_WORDS))
    counted = stored(counted_words(blocks, train_tokens, buckets), "lm-counts")
    corpus = Corpus(counted, train_tokens, train_docs)
    texts = stored(numbered_blocks(blocks, counted, corpus), "lm-texts")
    return scores(texts, train(texts, corpus.shares, states, iterations), train_tokens)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
