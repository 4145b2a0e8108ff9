"""Toxicity: a counterfactual-regularised classifier.

A logistic regression over the words present in a text and the words' beginnings
(inflected and compound forms share them).  Besides the labels it is
fitted to *counterfactual pairs*: in every labelled text that names a group, the name
is swapped for other names of its category and for a neutral word, and the change
of the whole text's score is penalised: that of the name and of every beginning that
comes or goes with it.  Neutral words and their beginnings carry no weight, so a
group's name cannot carry one either, however often it stood in toxic texts.

The fit uses a bounded sample of labelled ids, ``SAMPLE_ROWS`` at most (those whose hash
lies below a threshold), with one text each; it is the only bounded part, and the only
data broadcast are that sample's ids and the fitted weights.  Every document is scored
in full.  ``VOCABULARY`` and ``ASSOCIATED`` choose the model's words; both can be lifted.

Defined results: a null or empty text scores the model's base rate; a null ``doc_id``
is never held out (it has no remainder) and never trains; rows with a null label do
not train; an id with several labels is toxic if one of them is; an id with several
texts trains on the one of the smallest hash, repeated rows once; without both labels
every score is the smoothed share of toxic rows;
repeated rows score alike; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table, text_slices

SAMPLE_ROWS = 20_000
FOLDS = 5
VOCABULARY = 5_000  # words of the model, besides the groups' names
ASSOCIATED = 15.0  # least chi-squared statistic of a word
PREFIXES = (4, 5, 6, 7)  # letters of a word's beginnings
RIDGE = 0.1
COUNTERFACTUAL = 50.0  # weight of the pairs' penalty
STEPS = 600
SWAPS = 3  # names a name is swapped for in each text, besides the neutral one

# Names of groups, by category and number; the first of each is neutral.
GROUPS = {
    "origin": "people americans africans asians arabs mexicans chinese indians turks poles immigrants refugees foreigners ausländer flüchtlinge étrangers réfugiés inmigrantes refugiados",
    "faith": "believers christians muslims jews hindus buddhists atheists catholics christen muslime juden chrétiens musulmans juifs cristianos musulmanes judíos",
    "gender": "persons men women girls boys transgender männer frauen hommes femmes hombres mujeres",
    "orientation": "couples gay lesbian bisexual queer straight homosexual schwule lesben lesbiennes gays lesbianas",
    "colour": "someone black white brown schwarze weiße noirs blancs negros blancos",
    "ability": "patients disabled deaf blind autistic behinderte gehörlose handicapés sourds discapacitados sordos",
    "age": "folks elderly old young teenagers alte junge vieux jeunes ancianos jóvenes",
    # one of them, and the adjectives
    "one origin": "person american african asian arab mexican chinesisch turk turkish pole polish indian immigrant refugee foreigner foreign flüchtling ausländisch türkisch polnisch arabisch étranger étrangère réfugié réfugiée arabe immigré immigrée inmigrante refugiado refugiada extranjero extranjera árabe",
    "one faith": "believer christian muslim jew jewish hindu buddhist atheist catholic christ christlich muslimisch jude jüdin jüdisch chrétien chrétienne musulman musulmane juif juive cristiano cristiana musulmán judío judía",
    "one gender": "individual man woman girl boy male female mann frau weiblich männlich homme femme fille garçon hombre mujer chica chico",
    "one orientation": "partner lesbienne homosexuel homosexuelle homosexuell schwuler lesbe lesbisch lesbiana bisexuell bisexuel bisexuelle",
    "one colour": "somebody schwarz schwarzer weiß weißer noir noire blanc blanche negro negra blanco blanca",
    "one ability": "patient behindert behinderter gehörlos gehörloser blinder handicapé handicapée sourd sourde aveugle discapacitado discapacitada sordo sorda ciego ciega",
    "one age": "adult teenager pensioner alter alt jung junger vieille jeune anciano anciana joven",
}
CATEGORIES = {name: words.split() for name, words in GROUPS.items()}
NEUTRAL = {words[0]: name for name, words in CATEGORIES.items()}
CATEGORY_OF = {w: name for name, words in CATEGORIES.items() for w in words}

WORD = re.compile(r"[^\W\d_]+")


def with_beginnings(words: set[str]) -> set[str]:
    """Words and the beginnings of the longer ones, marked by a hyphen; neutral words
    have none, as they carry no weight."""
    return words | {w[:n] + "-" for w in words - NEUTRAL.keys() for n in PREFIXES if len(w) > n}


def words_of(text: str | None) -> set[str]:
    """What is present in a text: its runs of letters, lower-cased, and their beginnings."""
    return with_beginnings(set(WORD.findall((text or "").lower())))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, toxic): at most ``sample_rows`` training ids, those of the smallest hashes.

    A threshold on the hash is counted and lowered until few enough are below it, so
    nothing is sorted and no task gathers more than its own share.
    """
    id_ = F.col("doc_id").cast("long")
    usable = labels.select(id_.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    ids = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 53)))
    whole = 1 << 53
    below, found = whole, ids.count()
    while found > sample_rows:
        # a little under the share that would fill the sample, as hashes are not spread evenly
        below = int(below * max(0.25, 1 - 3 / max(1, sample_rows) ** 0.5) * sample_rows / found)
        found = ids.filter(F.col("place") < below).count()
    return stored(ids.filter(F.col("place") < below).select("doc_id", "toxic"), "labelled-sample")


def labelled_words(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(toxic, words) of the training sample: a row an id at most."""
    sample = labelled_sample(labels, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sorted(words_of(t)) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))],
                names=["toxic", "words"],
            )

    # the sample has at most sample_rows rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # repeated rows and ids meet in a partial aggregate before they are shuffled
    text = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    texts = texts.groupBy("doc_id", "toxic").agg(text).select("toxic", "first.text")
    return stored(texts.mapInArrow(run, "toxic int, words array<string>"), "labelled-words")


def vocabulary(rows: DataFrame, size: int | None = VOCABULARY, associated: float = ASSOCIATED) -> list[str]:
    """The words most associated with the label (``size`` of them, or all), and the groups' names."""
    totals = rows.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    n, toxic = totals["n"], totals["toxic"]
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").cast("double").alias("a"), F.count("*").cast("double").alias("df")
    )
    spread = F.col("df") * (n - F.col("df")) * float(toxic) * float(n - toxic)
    chi2 = F.when(spread > 0, F.pow(F.col("a") * n - F.col("df") * float(toxic), 2) * n / spread).otherwise(0.0)
    best = counts.withColumn("chi2", chi2).filter(F.col("chi2") >= associated)
    if size is not None:
        best = best.orderBy(F.col("chi2").desc(), "word").limit(size)
    names = sorted(CATEGORY_OF.keys() - NEUTRAL.keys())
    # at most as many words as the sampled texts have
    return names + sorted(r["word"] for r in best.select("word").collect() if r["word"] not in CATEGORY_OF)


def pairs_of(present: set[str], nth: int) -> list[tuple[str, str]]:
    """(name, other name) swaps for one text; the neutral name is always among them."""
    out = []
    for name in sorted(present & CATEGORY_OF.keys()):
        if name in NEUTRAL:
            continue
        neutral, *others = (w for w in CATEGORIES[CATEGORY_OF[name]] if w != name)
        chosen = [neutral] + [others[(nth + k) % len(others)] for k in range(min(SWAPS, len(others)))]
        out += [(name, other) for other in chosen if other not in present]
    return out


def changes_of(present: Iterable[str], nth: int, known: set[str] | dict[str, int]) -> Iterator[tuple[tuple[str, ...], tuple[str, ...]]]:
    """(lost, gained) words and beginnings of the model in each swap of one text.

    A text with several names is also compared to itself with neutral words only, as
    two names can share the beginnings that a single swap leaves in place.
    """
    words = {w for w in present if not w.endswith("-")}
    swapped = [(words - {name}) | {other} for name, other in pairs_of(words, nth)]
    names = {w for w in words & CATEGORY_OF.keys() if w not in NEUTRAL}
    if len(names) > 1:
        swapped.append((words - names) | {CATEGORIES[CATEGORY_OF[w]][0] for w in names})
    before = with_beginnings(words)
    for other in swapped:
        after = with_beginnings(other)
        lost, gained = (tuple(sorted(w for w in x if w in known)) for x in (before - after, after - before))
        if lost or gained:
            yield lost, gained


def fit(
    labels: np.ndarray,
    texts: list[set[str]],
    words: list[str],
    counterfactual: float = COUNTERFACTUAL,
    changes: dict[tuple[tuple[str, ...], tuple[str, ...]], int] | None = None,
):
    """Weights of ``words`` and an intercept, by accelerated gradient descent.

    Minimises log loss + ridge + counterfactual * (change of the score in a swap)^2,
    the last summed over the swaps of all texts.  ``changes`` counts the swaps' (lost,
    gained) words where ``texts`` are cut to the model's words.
    """
    index = {w: k for k, w in enumerate(words)}
    found = [sorted(index[w] for w in t if w in index) for t in texts]
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    col = np.array([k for f in found for k in f], np.int64)
    if changes is None:
        changes = Counter(c for nth, t in enumerate(texts) for c in changes_of(t, nth, index))
    signed = [[(index[w], -1.0) for w in lost] + [(index[w], 1.0) for w in gained] for lost, gained in changes]
    moved = np.array([len(x) for x in signed], np.int64)  # words that a swap changes
    swap = np.repeat(np.arange(len(signed)), moved)
    at = np.array([k for x in signed for k, _ in x], np.int64)
    sign = np.array([v for x in signed for _, v in x], np.float64)
    times = np.array(list(changes.values()), np.float64) * counterfactual

    n, size = len(found), len(words)
    y = labels.astype(np.float64)
    # a bound on the curvature of each coordinate sets its step
    per_row = np.bincount(row, minlength=n) + 1.0
    curvature = 0.25 * np.bincount(col, weights=per_row[row], minlength=size) + RIDGE
    pull = np.bincount(at, weights=(times * moved)[swap], minlength=size)
    step = 1.0 / (curvature + pull)
    step_0 = 1.0 / (0.25 * per_row.sum())
    w, ahead = np.zeros(size), np.zeros(size)
    rate = (y.sum() + 1) / (n + 2)
    w0 = ahead0 = float(np.log(rate / (1 - rate)))
    t = 1.0
    for _ in range(STEPS):
        z = np.bincount(row, weights=ahead[col], minlength=n) + ahead0
        error = 1 / (1 + np.exp(-z)) - y
        gradient = np.bincount(col, weights=error[row], minlength=size) + RIDGE * ahead
        change = times * np.bincount(swap, weights=sign * ahead[at], minlength=len(times))
        gradient += np.bincount(at, weights=sign * change[swap], minlength=size)
        following, following0 = ahead - step * gradient, ahead0 - step_0 * error.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = following + (before - 1) / t * (following - w)
        ahead0 = following0 + (before - 1) / t * (following0 - w0)
        w, w0 = following, following0
    return w, w0


def swap_changes(rows: DataFrame, words: list[str]) -> dict[tuple[tuple[str, ...], tuple[str, ...]], int]:
    """How often the swaps of all sampled texts lose and gain the same of ``words``."""
    known = set(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = [
                c
                for present in batch.column(0).to_pylist()
                if not CATEGORY_OF.keys().isdisjoint(present)
                for c in changes_of(present, zlib.crc32(" ".join(present).encode()), known)
            ]
            columns = [pa.array([list(c[k]) for c in found], pa.list_(pa.string())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["lost", "gained"])

    changes = rows.select("words").mapInArrow(run, "lost array<string>, gained array<string>")
    counts = changes.groupBy("lost", "gained").agg(F.count("*").alias("n")).collect()
    return {k: n for k, n in sorted(((tuple(r["lost"]), tuple(r["gained"])), r["n"]) for r in counts)}


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    vocabulary_size: int | None = VOCABULARY,
    associated: float = ASSOCIATED,
) -> tuple[dict[str, float], float]:
    """(weights by word, intercept)."""
    rows = labelled_words(docs, labels, sample_rows)
    totals = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.count("*").alias("n")).first()
    if not 0 < totals["toxic"] < totals["n"]:
        rate = (totals["toxic"] + 1) / (totals["n"] + 2)
        return {}, float(np.log(rate / (1 - rate)))
    chosen = vocabulary(rows, vocabulary_size, associated)
    place = {w: k for k, w in enumerate(chosen)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(sorted(place[w] for w in t if w in place), "<i4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["toxic", "at"])

    # at most sample_rows rows, of the model's words as numbers; ordered here, so that reruns agree
    sample = sorted((r["toxic"], bytes(r["at"])) for r in rows.mapInArrow(cut, "toxic int, at binary").collect())
    weights, intercept = fit(
        np.array([toxic for toxic, _ in sample]),
        [{chosen[k] for k in np.frombuffer(at, "<i4")} for _, at in sample],
        chosen,
        changes=swap_changes(rows, chosen),
    )
    return {w: float(x) for w, x in zip(chosen, weights) if x}, float(intercept)


def score_documents(docs: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.keys()
        for batch in text_slices(batches):
            z = np.array([sum(map(weights.__getitem__, sorted(known & words_of(t)))) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-(z + intercept))), pa.float64())], names=["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, intercept = train(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, weights, intercept)
