"""Quality rules: robust multivariate outliers per language and source.

Every document becomes a vector of transformed statistics.  For each (language,
source) the minimum-covariance-determinant estimate of location and scatter is
found by concentration steps over its documents that pass the base rules: keep the
half (``CORE``) with the smallest Mahalanobis distances, take their mean and
(consistency-corrected) covariance, repeat until the core stands.  As in the fast
algorithm for large samples, every group is first cut into subsets of bounded size,
which concentrate by themselves from medians and MADs; the pooled moments of all
subsets' cores start the steps over *all* documents.  Such a step is two group
aggregates (a quantile sketch and 44 sums), combined before the shuffle, so a source
that holds a third of the corpus costs what its rows cost; a group whose core stands
takes no part in further steps.  A half that stands is the estimate with the greatest
breakdown point; it is then reweighted: the mean and covariance of all documents within
the ``REWEIGHT`` quantile of it, which are more precise where nearly all are clean.  A
document is rejected if its distance exceeds the chi-squared quantile ``CUTOFF``.

A fixed ridge keeps features that hardly vary (no symbols at all in most sources)
from rejecting a document for a trace of them.  Groups with fewer than
``FEWEST`` documents are judged by their language, or by all documents.

Defined results: a null or empty text has no words and fails the base rules; null
``lang`` and ``source`` are values of their own; repeated rows are judged alike; an
empty table gives an empty result; extra columns are ignored by :func:`verdicts`
and kept by :func:`keep_good`.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import SPACE_CHARS, free_name, stored, table, text_slices, utf8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CORE = 0.5  # share of a group's documents that the estimate rests on
REWEIGHT = 0.975  # of the chi-squared distribution: documents that the final estimate rests on
STANDS = 1e-3  # a core stands once no mean moves by more than this share of its feature's ridge
CUTOFF = 0.99999  # of the chi-squared distribution of squared distances
SUBSET = 1500  # documents, about, of a subset that concentrates by itself
STEPS = 30  # concentration steps at most, of a subset and over all documents
FEWEST = 40  # documents of a group with an estimate of its own
QUANTILE_ACCURACY = 10_000
BROADCAST_GROUPS = 10_000  # of about 600 bytes each

# feature -> ridge: the spread below which differences in it say nothing
FEATURES = {
    "word_length": 0.06,
    "symbols": 0.10,
    "dup_lines": 0.15,
    "repeats": 0.15,
    "capitals": 0.08,
    "digits": 0.10,
    "punctuation": 0.12,
    "variety": 0.05,
}
SIZE = len(FEATURES)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("x", T.ArrayType(T.DoubleType()))]
)
SYMBOLS = b"#*$%&|<>"


def chi2_cdf(x: float, freedom: int) -> float:
    """Closed form, for an even number of degrees of freedom."""
    half = x / 2
    term, total = 1.0, 0.0
    for j in range(freedom // 2):
        total += term
        term *= half / (j + 1)
    return 1 - math.exp(-half) * total


def chi2_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, freedom) < share else (low, mid)
    return low


def consistency(share: float) -> float:
    """The covariance of all of a normal sample, relative to that of the nearest ``share`` of it."""
    return share / chi2_cdf(chi2_quantile(share, SIZE), SIZE + 2)


CONSISTENCY = consistency(CORE)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, width):
        if int(key.max()) >= (1 << 62) // len(number):
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k : k + n]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, np.int64)
    found = np.flatnonzero(counts[inverse] > 1)
    covered[found] += 1  # positions are distinct
    covered[: len(words)] -= np.bincount(found + width, minlength=len(words) + 1)[: len(words)]
    return int((np.cumsum(covered[: len(words)]) > 0).sum())


def statistics(text: str | None) -> tuple[int, int, int, int, int, list[float]]:
    """The counts of the contract and the transformed vector of one text."""
    data = utf8(text)
    words = data.split()
    n = len(words)
    without = lambda these: len(data) - len(data.translate(None, these))
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = without(SYMBOLS)
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE_CHARS)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    if not n:
        return 0, 0, symbols, 0, 0, [0.0] * SIZE
    upper = without(string.ascii_uppercase.encode())
    letters = upper + without(string.ascii_lowercase.encode())
    vector = [
        math.log(chars / n),
        math.sqrt(symbols / n),
        math.sqrt(dup_lines / len(lines)),
        math.sqrt(repeats / n),
        math.sqrt(upper / max(1, letters)),
        math.sqrt(without(string.digits.encode()) / chars),
        math.log1p(without(string.punctuation.encode()) / n),
        math.log1p(len(set(words))) / math.log1p(n),
    ]
    return n, chars, symbols, dup_lines, repeats, vector


def with_statistics(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and a struct column ``name`` of the statistics of ``text``."""
    text_at = docs.columns.index("text")
    struct = pa.struct([(c, pa.int64()) for c in COUNTS] + [("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            values = [dict(zip([*COUNTS, "x"], statistics(t))) for t in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, struct)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, STATS)]))


def base_failed(stats: str):
    n, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)


def _levels(lang, source) -> list:
    """A document's groups, the finest first."""
    as_json = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    return [as_json(lang.alias("lang"), source.alias("source")), as_json(lang.alias("lang")), F.lit("all")]


PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
SUMS = [f"s{i}" for i in range(SIZE)] + [f"p{i}_{j}" for i, j in PAIRS]
MOMENTS = "level string, core double, " + ", ".join(f"{c} double" for c in SUMS)
PARAMS = "level string, mean array<double>, inverse array<double>"
RIDGE = np.diag(np.array(list(FEATURES.values())) ** 2)


def _distance(x, mean, inverse):
    """Squared Mahalanobis distance of the array ``x``."""
    z = [x[i] - mean[i] for i in range(SIZE)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + inverse[i * SIZE + j] * z[i] * z[j] * (1.0 if i == j else 2.0)
    return total


def distances(x: np.ndarray, mean: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    z = x - mean
    return np.einsum("ij,jk,ik->i", z, np.linalg.inv(scatter), z)


def estimate(
    core: float, sums: np.ndarray, products: np.ndarray, factor: float = CONSISTENCY
) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scatter from a core's count, sums and (upper triangle of) cross products."""
    mean = sums / core
    cross = np.zeros((SIZE, SIZE))
    for value, (i, j) in zip(products, PAIRS):
        cross[i, j] = cross[j, i] = value / core
    return mean, (cross - np.outer(mean, mean)) * factor + RIDGE


def moments_of(x: np.ndarray) -> np.ndarray:
    """[count, sums, cross products] of some rows."""
    return np.concatenate([[len(x)], x.sum(axis=0), [(x[:, i] * x[:, j]).sum() for i, j in PAIRS]])


def core_of(x: np.ndarray) -> np.ndarray:
    """Concentration steps on one subset, from medians and MADs until the core stands."""
    mean = np.median(x, axis=0)
    scatter = np.diag((np.median(abs(x - mean), axis=0) * 1.4826) ** 2) + RIDGE
    before = None
    for _ in range(STEPS):
        d = distances(x, mean, scatter)
        inside = d <= np.quantile(d, CORE, method="inverted_cdf")
        if before is not None and (inside == before).all():
            break
        before = inside
        m = moments_of(x[inside])
        mean, scatter = estimate(m[0], m[1 : SIZE + 1], m[SIZE + 1 :])
    return moments_of(x[before])


def _subset(key, part):
    x = part.column("x").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, SIZE)
    values = core_of(x)
    return pa.table({"level": [key[0].as_py()], **{c: [float(v)] for c, v in zip(["core", *SUMS], values)}})


def _params(moments: DataFrame, factor: float = CONSISTENCY) -> DataFrame:
    """Moments of each group's core -> its mean and inverse scatter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1) if batch.num_rows else []
            found = [estimate(v[0], v[1 : SIZE + 1], v[SIZE + 1 :], factor) for v in values]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([m.tolist() for m, _ in found], pa.list_(pa.float64())),
                    pa.array([np.linalg.inv(s).ravel().tolist() for _, s in found], pa.list_(pa.float64())),
                ],
                names=["level", "mean", "inverse"],
            )

    return moments.mapInArrow(run, PARAMS)


def small(df: DataFrame, groups: int) -> DataFrame:
    """A table of one row a group, marked for broadcast if its groups are counted and few;
    beyond that the join shuffles and Spark splits the large groups' partitions."""
    return F.broadcast(df) if groups <= BROADCAST_GROUPS else df


def _measured(rows: DataFrame, params: DataFrame, groups: int) -> DataFrame:
    """(level, x, d): the documents of the groups that ``params`` has, with their distances."""
    return rows.join(small(params, groups), "level").select(
        "level", "x", _distance(F.col("x"), F.col("mean"), F.col("inverse")).alias("d")
    )


def _moments(core: DataFrame) -> DataFrame:
    x = F.col("x")
    return core.groupBy("level").agg(
        F.count("*").cast("double").alias("core"),
        *(F.sum(x[i]).alias(f"s{i}") for i in range(SIZE)),
        *(F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in PAIRS),
    )


def _step(rows: DataFrame, params: DataFrame, groups: int) -> DataFrame:
    """One concentration step over all documents of every group of ``params``."""
    measured = _measured(rows, params, groups)
    bounds = measured.groupBy("level").agg(F.percentile_approx("d", CORE, QUANTILE_ACCURACY).alias("bound"))
    core = measured.join(small(bounds, groups), "level").filter("d <= bound")
    return stored(_params(_moments(core)), "quality-params")


def _concentrated(rows: DataFrame, params: DataFrame, groups: int) -> DataFrame:
    """Steps until every group's core stands."""
    spreads = list(FEATURES.values())
    shift = F.greatest(*(F.abs(F.col("mean")[i] - F.col("before")[i]) / spreads[i] for i in range(SIZE)))
    standing = []
    for _ in range(STEPS):
        before = params.select("level", F.col("mean").alias("before"))
        stepped = _step(rows, params, groups).join(before, "level").withColumn("moves", shift > STANDS)
        stepped = stored(stepped.drop("before"), "quality-params")
        standing.append(stepped.filter("NOT moves").drop("moves"))
        params = stepped.filter("moves").drop("moves")
        if params.isEmpty():
            break
    out = params
    for more in standing:
        out = out.unionByName(more)
    return stored(out, "quality-params")


def fit(stats: DataFrame) -> DataFrame:
    """(doc_id, lang, source, x) of the documents that pass the base rules -> params of each group."""
    fine, coarse, whole = _levels(F.col("lang"), F.col("source"))
    base = stored(stats.select("x", F.xxhash64("doc_id", "x").alias("row"), fine.alias("fine"), coarse.alias("coarse")), "quality-rows")
    counts = stored(base.groupBy("fine", "coarse").agg(F.count("*").alias("n")), "quality-counts")
    # a coarser group is needed only where a finer one is too small
    languages = counts.groupBy("coarse").agg(F.sum("n").alias("n"), F.min("n").alias("least")).filter(F.col("least") < FEWEST)
    languages = stored(languages, "quality-counts")
    levels = counts.filter(F.col("n") >= FEWEST).select(F.col("fine").alias("level"), "n").unionByName(
        languages.filter(F.col("n") >= FEWEST).select(F.col("coarse").alias("level"), "n")
    )
    if not languages.filter(F.col("n") < FEWEST).isEmpty():
        levels = levels.unionByName(counts.agg(F.sum("n").alias("n")).select(whole.alias("level"), "n"))
    levels = stored(levels, "quality-levels")
    groups = levels.count()
    rows = base.select("x", "row", F.explode(F.array("fine", "coarse", whole)).alias("level")).join(small(levels, groups), "level")
    rows = stored(rows, "quality-rows")
    # every group is cut into subsets of bounded size; their cores' moments add up to a start
    subset = F.pmod(F.col("row"), F.ceil(F.col("n") / SUBSET))
    subsets = rows.withColumn("subset", subset).groupBy("level", "subset").applyInArrow(_subset, MOMENTS)
    start = subsets.groupBy("level").agg(*(F.sum(c).alias(c) for c in ["core", *SUMS]))
    params = stored(_params(start), "quality-params")
    params = _concentrated(rows.select("level", "x"), params, groups)
    near = _measured(rows, params, groups).filter(F.col("d") <= chi2_quantile(REWEIGHT, SIZE))
    return stored(_params(_moments(near), consistency(REWEIGHT)), "quality-params")


def _judge(df: DataFrame, stats: str, params: DataFrame, verdict: str) -> DataFrame:
    """``df`` and a boolean column: passes the base rules and is no outlier."""
    cutoff = chi2_quantile(CUTOFF, SIZE)
    levels = _levels(F.col("lang"), F.col("source"))
    d = None
    extra = []
    groups = params.count()
    for k, level in enumerate(levels[:2]):
        names = {c: free_name(df, f"quality_{c}_{k}") for c in ("level", "mean", "inverse")}
        extra += names.values()
        own = small(params.select(*(F.col(c).alias(n) for c, n in names.items())), groups)
        df = df.withColumn(free_name(df, f"quality_key_{k}"), level)
        key = df.columns[-1]
        extra.append(key)
        df = df.join(own, F.col(key) == F.col(names["level"]), "left")
        mine = _distance(F.col(f"{stats}.x"), F.col(names["mean"]), F.col(names["inverse"]))
        d = mine if d is None else F.coalesce(d, mine)
    whole = params.filter(F.col("level") == levels[2]).first()
    if whole is not None:  # one row, where some language is too small
        literal = lambda values: [F.lit(v) for v in values]
        d = F.coalesce(d, _distance(F.col(f"{stats}.x"), literal(whole["mean"]), literal(whole["inverse"])))
    judged = df.withColumn(verdict, ~base_failed(stats) & F.coalesce(d <= cutoff, F.lit(True)))
    return judged.drop(*extra)


def _fitted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    narrow = with_statistics(docs.select("doc_id", "lang", "source", "text"), "stats").drop("text")
    stats = stored(narrow, "quality-stats")
    return stats, fit(stats.filter(~base_failed("stats")).select("doc_id", "lang", "source", "stats.x"))


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts, base_failed, kept) of every document."""
    stats, params = _fitted(docs)
    return _judge(stats, "stats", params, "kept").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.col(f"stats.{c}").alias(c) for c in COUNTS),
        base_failed("stats").alias("base_failed"),
        "kept",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected documents, columns unchanged.

    Texts and statistics are written beside each other once, so no text is read twice.
    """
    stats = free_name(docs, "quality_stats")
    kept = free_name(docs, "quality_kept")
    both = stored(with_statistics(docs, stats), "quality-docs")
    params = fit(both.filter(~base_failed(stats)).select("doc_id", "lang", "source", F.col(f"{stats}.x").alias("x")))
    return _judge(both, stats, params, kept).filter(F.col(kept)).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))
