"""Mixing sources to target weights: Efraimidis-Spirakis sampling, DataFrame functions only.

1. Sizes (words), a quality weight and an exponential key ``-ln(u) / weight`` for
   every document, where ``u`` is a hash of its id: reruns agree.
2. Targets: the sources share the wanted total by weight; none gets more than
   ``MOST_EPOCHS`` times its size, and what it cannot take is shared by the rest.
   The share per unit of weight is raised until no further source is capped; a
   round is one aggregate over the (small) table of sources.
3. A source takes as many complete epochs as fit its target; for the rest it takes
   documents in key order while their middle lies within the remaining budget.
   Equal rows are one row with a count before anything is sorted, and exactly as many
   of them are taken as the budget holds.  The prefix sums run in two levels: the key is
   cut into ranges of about ``DOCS_PER_RANGE`` documents, whose totals are summed up
   first, so no task sees more than a range of a hot source's documents.

Defined results: a null text has size 0; a null ``source`` is a source of its own and
comes last; sources of size 0 have target 0; ties of the key are broken by ``doc_id``
(null last), size and a hash of the text; rows equal in these are interchangeable, so
which of them the fractional part takes is open, but not how many; an empty table gives
an empty result; extra columns are ignored by :func:`mix` and kept by
:func:`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import SPACE, SPACE_CHARS, few, free_name, stored, table

WEIGHTS = (3, 1, 2)  # by rank of the source, repeating
TOTAL_SHARE = 1.5  # of all sizes
MOST_EPOCHS = 2
DOCS_PER_RANGE = 1000
ROWS_AT_ONCE = 1000  # copies of a row that one task makes
MARKS = "#*$%&|<>!"  # characters that lower a document's weight


def size_of(text: Column) -> Column:
    """Words of a text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"[{SPACE}]+"))).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 1/2 (nothing but marks) and 1 (none)."""
    marks = F.length(text) - F.length(F.translate(text, MARKS, ""))
    return F.coalesce(1.0 / (1.0 + marks / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """Exponential with rate ``weight``, from 52 bits of the id's MD5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    u = (bits.cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _order(doc_id: Column, size: Column, text_hash: Column, key: Column) -> Column:
    """What a source's documents are sorted by; nulls last."""
    return F.struct(key.alias("key"), doc_id.isNull().alias("no_id"), doc_id.alias("id"), size.alias("size"), text_hash.alias("hash"))


def _keyed(docs: DataFrame) -> DataFrame:
    id_ = F.col("doc_id").cast("long")
    size = size_of(F.col("text"))
    return docs.select(
        id_.alias("doc_id"),
        "source",
        size.alias("size"),
        _order(id_, size, F.xxhash64("text"), sampling_key(id_, quality_weight(F.col("text")))).alias("place"),
    )


def targets(sizes: DataFrame, total_share: float = TOTAL_SHARE) -> DataFrame:
    """(source, n, source_size) -> the same and (weight, target)."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row a source
    listed = F.array(*(F.lit(w) for w in WEIGHTS))
    sizes = stored(
        sizes.withColumn("rank", rank).withColumn("weight", F.element_at(listed, (F.col("rank") - 1) % len(WEIGHTS) + 1)),
        "mix-sources",
    )
    cap = F.col("source_size") * MOST_EPOCHS
    per_weight, capped_before = 0.0, -1
    while True:
        capped = F.lit(per_weight) * F.col("weight") > cap
        r = sizes.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, cap)).alias("given"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weights"),
            F.count(F.when(capped, 1)).alias("capped"),
        ).first()
        if not r["weights"] or r["capped"] == capped_before:
            break
        capped_before = r["capped"]
        per_weight = (total_share * r["all"] - (r["given"] or 0)) / r["weights"]
    target = F.least(F.lit(per_weight) * F.col("weight"), cap.cast("double"))
    return sizes.select("source", "n", "source_size", "weight", target.alias("target"))


def _with_epochs(wanted: DataFrame) -> DataFrame:
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return wanted.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )


def _chosen(docs: DataFrame, total_share: float) -> tuple[DataFrame, DataFrame]:
    """Distinct documents (``rows`` of each) with their source's figures and how many of the
    rows the fractional part takes."""
    equal = _keyed(docs).groupBy("doc_id", "source", "size", "place").agg(F.count("*").alias("rows"))
    rows = stored(equal, "mix-documents")
    sizes = rows.groupBy("source").agg(F.sum("rows").alias("n"), F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    wanted = stored(_with_epochs(targets(sizes, total_share)), "mix-targets")
    own = few(wanted.withColumnRenamed("source", "of_source"))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / DOCS_PER_RANGE))
    # 1 - exp(-key) is about uniform and grows with the key
    ranged = (
        rows.join(own, rows["source"].eqNullSafe(own["of_source"]))
        .drop("of_source")
        .withColumn("range", F.floor((1 - F.exp(-F.col("place.key"))) * ranges).cast("long"))
    )
    all_words = F.col("size") * F.col("rows")
    sums = ranged.groupBy("source", "range").agg(F.sum(all_words).alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        F.col("source").alias("of_source"),
        F.col("range").alias("of_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before"),
    )
    within = Window.partitionBy("source", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(
        before, ranged["source"].eqNullSafe(before["of_source"]) & (ranged["range"] == before["of_range"])
    ).withColumn("start", F.col("before") + F.coalesce(F.sum(all_words).over(within), F.lit(0)))
    # the row after k equal ones is taken if its middle, start + k * size + size / 2, lies within the rest
    fitting = F.floor((F.col("rest") - F.col("start") - F.col("size") / 2) / F.col("size")) + 1
    taken = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(fitting, F.col("rows")))).otherwise(F.lit(0))
    return placed.withColumn("taken_rows", taken.cast("long")), wanted


def repeated(df: DataFrame, times: str, number: str) -> DataFrame:
    """Every row ``times`` times, numbered from 1; the copies of one row are dealt over tasks."""
    few_ = df.filter(F.col(times).between(1, ROWS_AT_ONCE)).withColumn(number, F.explode(F.sequence(F.lit(1), F.col(times))))
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / ROWS_AT_ONCE)))
    many = df.filter(F.col(times) > ROWS_AT_ONCE).withColumn(number, parts)
    first = F.col(number) * ROWS_AT_ONCE
    many = many.hint("rebalance").withColumn(
        number, F.explode(F.sequence(first + 1, F.least(first + ROWS_AT_ONCE, F.col(times))))
    )
    return few_.unionByName(many)


def mix(docs: DataFrame, total_share: float = TOTAL_SHARE) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, chosen, taken) of every document."""
    placed, _ = _chosen(docs, total_share)
    columns = ["doc_id", "source", "size", "source_size", "target", "epochs", "rows", "taken_rows"]
    every = repeated(placed.select(*columns), "rows", "nth").withColumn("chosen", F.col("nth") <= F.col("taken_rows"))
    copies = F.col("epochs") + F.col("chosen").cast("long")
    return every.select(*columns[:6], "chosen", (F.col("size") * copies).alias("taken"))


def mixed_documents(docs: DataFrame, total_share: float = TOTAL_SHARE) -> DataFrame:
    """``docs`` with every document as often as the mix takes it, columns unchanged.

    Only the last place taken of each source is joined to the documents, so no text
    is shuffled while the sources are few.  Where only some of the rows of that place
    are taken, their copies come from one of them, as they are equal.
    """
    placed, wanted = _chosen(docs, total_share)
    last = placed.filter("taken_rows > 0").groupBy("source").agg(
        F.max(F.struct("place", "taken_rows", (F.col("taken_rows") < F.col("rows")).alias("partly"))).alias("at")
    )
    last = last.select(F.col("source").alias("last_source"), "at.place", "at.taken_rows", "at.partly")
    wanted = wanted.join(last, wanted["source"].eqNullSafe(last["last_source"]), "left")
    wanted = stored(wanted.select("source", "epochs", F.col("place").alias("last"), "taken_rows", "partly"), "mix-last")
    names = {c: free_name(docs, f"mix_{c}") for c in ("source", "epochs", "last", "taken_rows", "partly", "place", "copy", "row")}
    own = few(wanted.select(*(F.col(c).alias(names[c]) for c in wanted.columns)))
    id_, size = F.col("doc_id").cast("long"), size_of(F.col("text"))
    place = _order(id_, size, F.xxhash64("text"), sampling_key(id_, quality_weight(F.col("text"))))
    mine = {c: F.col(n) for c, n in names.items()}
    joined = docs.join(own, docs["source"].eqNullSafe(own[names["source"]])).withColumn(names["place"], place)
    within = F.when(mine["partly"], mine["place"] < mine["last"]).otherwise(mine["place"] <= mine["last"])
    chosen = F.coalesce(within & (F.col(f"{names['place']}.size") > 0), F.lit(False))
    copies = (mine["epochs"] + chosen.cast("long")).cast("int")
    out = joined.withColumn(names["copy"], F.explode(F.array_repeat(F.lit(1), copies))).select(*docs.columns)
    partly = wanted.filter("partly")
    if partly.isEmpty():
        return out
    # one of the equal rows of each last place, found among the documents of its id
    ids = partly.select(F.col("last.id").alias(names["row"])).distinct()
    tied = joined.join(few(ids), F.col("doc_id").cast("long").eqNullSafe(F.col(names["row"])), "left_semi")
    tied = tied.filter(mine["partly"] & (mine["place"] == mine["last"]))
    one = tied.groupBy(names["source"]).agg(
        F.first(mine["taken_rows"]).alias(names["taken_rows"]), F.first(F.struct(*docs.columns)).alias(names["row"])
    )
    extra = repeated(one, names["taken_rows"], names["copy"]).select(f"{names['row']}.*")
    return out.union(extra)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = """
WITH keyed AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           * (1.0::DOUBLE + (length(text) - length(regexp_replace(text, '[#*$%&|<>!]', '', 'g'))) / greatest(length(text), 1)::DOUBLE) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM keyed GROUP BY source
), steps AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(weight) OVER (ORDER BY cap / weight::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
         sum(source_size) OVER () AS total
  FROM sources
), share AS (
  SELECT (1.5::DOUBLE * total - given) / weights AS per_weight FROM steps
  WHERE (1.5::DOUBLE * total - given) / weights * weight <= cap
  ORDER BY cap / weight::DOUBLE, source LIMIT 1
), targets AS (
  SELECT source, source_size, least(per_weight * weight, cap::DOUBLE) AS target FROM sources, share
), placed AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + (size > 0 AND start + size / 2.0::DOUBLE <= target - epochs * source_size)::INT))::BIGINT AS taken
FROM placed
"""
