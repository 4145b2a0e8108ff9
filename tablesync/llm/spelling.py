"""Spelling variant grouping by finite-state composition.

The vocabulary is a minimised acceptor A; A o E o A, with E the transducer that copies
letters and makes exactly one edit, accepts the pairs of words one edit apart.  The
composed machine is enumerated per partition of initial states:

1. The acceptor is cut below its root: a word's *initial state* is its shortest prefix
   with at most ``STATE_WORDS`` words behind it.  A prefix with more is cut one letter
   later, so no partition is large, whatever letters the words begin with.
2. While E still copies, both words walk the same path, so a pair whose first difference
   lies behind an initial state is found inside that state's partition: a task builds the
   minimal acceptor of the remainders there and enumerates the composition, following
   only pairs of states that have a remainder in common.
3. Where E edits on the way to the initial state (the depth at which the words part is
   above the cut), the machine is past its only edit and both words must accept the same
   remainder.  That part of the composition is an equality join on (depth, word without
   the letter there); a group has at most one word a letter, and the word without one.

Each pair comes out once per direction, at the depth where the two words first differ.

A word's form is its near word of largest count, if that is ``DOMINANCE`` times its own;
roots follow forms by doubling joins (a chain's counts grow fivefold a step, so it is
short).  Counting is exact over all texts: runs are counted per document, summed per
task, then per word.

Defined results: a null or empty text has no run; a null ``doc_id`` reads as an empty
text in the hashed string; repeated rows count once each; ties between near words go to
the smallest in code-point order; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import few, stored, table, text_slices

MIN_LETTERS = 6
MIN_COUNT = 5
DOMINANCE = 5
EDITED_EVERY = 199  # the contract's typing errors: runs whose hash this divides lose a letter
STATE_WORDS = 2_000  # words of one initial state at most
TASK_WORDS = 20_000  # words, about, that one task composes
HELD_WORDS = 200_000  # distinct words a task sums up before it passes them on

# Latin-1 bytes: letters stay (A-Z in lower case, U+00C0 to U+00FF as they are), all others part runs.
RUNS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def document_words(doc: int | None, text: str | None) -> Iterator[tuple[bytes, int]]:
    """(word as Latin-1, occurrences) of one text, after the contract's deletions."""
    if not text:
        return
    seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(RUNS).split()).items():
        if len(run) < MIN_LETTERS:
            continue  # a deletion only shortens it
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % EDITED_EVERY == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1 :]
            if len(run) < MIN_LETTERS:
                continue
        yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of at least ``MIN_LETTERS`` letters found at least ``MIN_COUNT`` times."""

    def out(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in text_slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in document_words(doc, text):
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= HELD_WORDS:
                    yield out(counts)
                    counts = {}
        yield out(counts)

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def initial_states(words: DataFrame) -> DataFrame:
    """Adds ``depth``: the length of the word's shortest prefix with at most ``STATE_WORDS``
    words behind it; one more than the word's length if it ends before such a prefix."""
    if words.count() <= STATE_WORDS:
        return words.withColumn("depth", F.lit(0))
    length = F.length("word")
    settled, open_, low, span = None, words, 0, 4
    while True:
        high = low + span
        at = F.explode(F.sequence(F.lit(low + 1), F.least(length, F.lit(high))))
        prefixes = open_.filter(length > low).select("word", at.alias("d"))
        prefixes = prefixes.select("word", "d", F.substr("word", F.lit(1), F.col("d")).alias("prefix"))
        crowded = stored(
            prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > STATE_WORDS).select("prefix"),
            "spelling-crowded",
        )
        deepest = prefixes.join(few(crowded), "prefix").groupBy("word").agg(F.max("d").alias("deepest"))
        known = open_.join(deepest, "word", "left").select("word", "n", (F.coalesce("deepest", F.lit(low)) + 1).alias("depth"))
        known = stored(known, "spelling-states")
        further = (F.col("depth") == high + 1) & (length > high)
        done = known.filter(~further)
        settled = done if settled is None else settled.unionByName(done)
        open_, low, span = known.filter(further).select("word", "n"), high, 2 * span
        if open_.isEmpty():
            return settled


def minimal_acceptor(words: list[str]) -> tuple[list[tuple[bool, dict[str, int]]], int]:
    """The minimal acyclic acceptor of sorted distinct words: (final, arcs) of each state, the initial state."""
    states: list[tuple[bool, dict[str, int]]] = []
    register: dict[tuple, int] = {}
    path: list[tuple[bool, dict[str, int]]] = [(False, {})]  # states of the last word, not yet registered
    last = ""

    def settle(keep: int) -> None:
        while len(path) > keep:
            final, arcs = path.pop()
            key = (final, tuple(arcs.items()))
            if key not in register:
                register[key] = len(states)
                states.append((final, arcs))
            if path:
                path[-1][1][last[len(path) - 1]] = register[key]

    for word in words:
        shared = 0
        while shared < len(last) and shared < len(word) and last[shared] == word[shared]:
            shared += 1
        settle(shared + 1)
        path.extend((False, {}) for _ in range(len(word) - shared))
        path[-1] = (True, path[-1][1])
        last = word
    settle(1)
    final, arcs = path.pop()
    states.append((final, arcs))
    return states, len(states) - 1


class Composition:
    """A o E o A over one acceptor, behind the initial states."""

    def __init__(self, words: list[str]):
        self.states, self.initial = minimal_acceptor(words)
        self.meets: dict[tuple[int, int], bool] = {}
        self.parted: dict[int, list[tuple[str, str]]] = {}

    def common_arcs(self, a: int, b: int) -> list[tuple[str, int, int]]:
        left, right = self.states[a][1], self.states[b][1]
        if len(left) > len(right):
            return [(c, left[c], s) for c, s in right.items() if c in left]
        return [(c, s, right[c]) for c, s in left.items() if c in right]

    def meet(self, a: int, b: int) -> bool:
        """Whether the states a and b accept a remainder in common."""
        stack = [(a, b)]
        while stack:
            pair = stack[-1]
            x, y = pair
            if pair in self.meets:
                stack.pop()
            elif x == y or (self.states[x][0] and self.states[y][0]):
                self.meets[pair] = True
                stack.pop()
            else:
                nexts = [(p, q) for _, p, q in self.common_arcs(x, y)]
                if any(self.meets.get(p) for p in nexts):
                    self.meets[pair] = True
                    stack.pop()
                else:
                    unknown = [p for p in nexts if p not in self.meets]
                    if unknown:
                        stack.append(unknown[0])
                    else:
                        self.meets[pair] = False
                        stack.pop()
        return self.meets[a, b]

    def remainders(self, a: int, b: int, but: str = "") -> Iterator[str]:
        """The remainders that a and b both accept, but those that begin with the letter ``but``."""
        stack = [("", a, b)]
        while stack:
            so_far, x, y = stack.pop()
            if self.states[x][0] and self.states[y][0]:
                yield so_far
            stack.extend(
                (so_far + c, p, q) for c, p, q in self.common_arcs(x, y) if (so_far or c != but) and self.meet(p, q)
            )

    def partings(self, state: int) -> list[tuple[str, str]]:
        """The pairs of remainders of ``state`` whose first letters differ and that one edit makes equal."""
        if state not in self.parted:
            out = []
            arcs = list(self.states[state][1].items())
            for k, (c, p) in enumerate(arcs):
                for d, q in arcs[k + 1 :]:  # replace
                    if self.meet(p, q):
                        out.extend((c + y, d + y) for y in self.remainders(p, q))
                out.extend((y, c + y) for y in self.remainders(state, p, but=c))  # insert
            self.parted[state] = out
        return self.parted[state]

    def pairs(self) -> Iterator[tuple[str, str]]:
        stack = [("", self.initial)]
        while stack:
            path, state = stack.pop()
            for a, b in self.partings(state):
                yield path + a, path + b
            stack.extend((path + c, s) for c, s in self.states[state][1].items())


PAIRS = "word string, near string, near_n long"


def pairs_behind(words: DataFrame) -> DataFrame:
    """The pairs that first differ behind their common initial state."""

    def compose(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("rest").to_pylist(), group.column("n").to_pylist()))
        prefix = group.column("prefix")[0].as_py()
        counts = dict(rows)
        found = [p for u, v in Composition([r for r, _ in rows]).pairs() for p in ((u, v), (v, u))]
        return pa.table(
            [
                pa.array([prefix + u for u, _ in found], pa.string()),
                pa.array([prefix + v for _, v in found], pa.string()),
                pa.array([counts[v] for _, v in found], pa.int64()),
            ],
            names=["word", "near", "near_n"],
        )

    prefix = F.substr("word", F.lit(1), F.col("depth"))
    rest = F.substr("word", F.col("depth") + 1, F.length("word"))
    inside = words.filter(F.col("depth") <= F.length("word")).select(prefix.alias("prefix"), rest.alias("rest"), "n")
    # words are few bytes and much work: the number of tasks follows the words, not their size
    tasks = max(1, -(-words.count() // TASK_WORDS))
    return inside.repartition(tasks, "prefix").groupBy("prefix").applyInArrow(compose, PAIRS)


def pairs_before(words: DataFrame) -> DataFrame:
    """The pairs that first differ on the way to their initial states."""
    length, at = F.length("word"), F.col("at")
    without = words.filter("depth > 0").select(
        "word", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("depth"), length) - 1)).alias("at")
    )
    without = without.select(
        "word", "n", "at",
        F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2, length)).alias("rest"),
        F.substr("word", at + 1, F.lit(1)).alias("letter"),
    )
    whole = words.filter("depth > 0").select(
        "word", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("depth"), length + 1) - 1)).alias("at")
    )
    whole = whole.select("word", "n", "at", F.col("word").alias("rest"), F.lit("").alias("letter"))
    ways = stored(without.union(whole), "spelling-ways")
    left, right = ways.alias("l"), ways.alias("r")
    following = F.substr("l.rest", F.col("l.at") + 1, F.lit(1))
    # a letter put in before its like: the words first differ further on
    later = ((F.col("l.letter") == "") & (F.col("r.letter") == following)) | (
        (F.col("r.letter") == "") & (F.col("l.letter") == following)
    )
    joined = left.join(right, (F.col("l.at") == F.col("r.at")) & (F.col("l.rest") == F.col("r.rest")))
    return joined.filter((F.col("l.letter") != F.col("r.letter")) & ~later).select(
        F.col("l.word").alias("word"), F.col("r.word").alias("near"), F.col("r.n").alias("near_n")
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n) -> (word, near, near_n): all pairs one edit apart, in both directions."""
    words = stored(initial_states(words), "spelling-words")
    return pairs_behind(words).unionByName(pairs_before(words))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) of the words that have a form -> (word, root), following forms to the last."""
    known = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = stored(
            known.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        known = followed.select("word", "root")
        if followed.filter("moved").isEmpty():
            return known


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = stored(vocabulary(docs), "spelling-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    dominant = -F.col("best.minus_n") >= DOMINANCE * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(dominant, F.col("best.near")).alias("form"), F.when(dominant, -F.col("best.minus_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return judged.join(roots(judged.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY 1, 2),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, len(x), 2), lambda i: ('0x' || x[i + 1:i + 2])::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda p, q: xor(p >> 1, 3988292384 * (p & 1))))) AS h
  FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs)),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, min({'m': -near_n, 'w': near}) AS b FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.m >= 5 * w.n THEN b.w END AS form, CASE WHEN -b.m >= 5 * w.n THEN -b.m END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
