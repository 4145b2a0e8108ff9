"""Secret scans: multipart credential linking, DataFrame functions only.

Strong patterns (assignments, access identifiers, long hex runs) are reported as
they are.  Weak parts - account names, mixed tokens or short passwords, endpoints -
are reported only where complementary parts co-occur: an identifier or an endpoint
needs a secret within the scope of ``SCOPE`` code points, a secret needs an
identifier or an endpoint; strong matches count as parts, and a weak part that
overlaps a strong match is that match.  The scopes are matched by an interval
(semi) join: a part is listed under every ``BIN`` code points that it reaches, so a
bin's parts are bounded by its width and no pairs are emitted.

Match positions come from the lengths of matches and of the text between them; only
those lengths leave the scan.

Defined results: a null or empty text has no spans; a null ``doc_id`` stays null;
repeated rows are scanned one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table

SCOPE = 200
BIN = 512

# kind, pattern, group whose length counts, least length, role.  The first three are
# fixed by the contract; for the last two of them the least length is part of the
# pattern, because a run that is too short has no longer match inside.
BASE = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, "secret"),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16, "identifier"),
    ("hex", r"[0-9a-f]{32,}", 0, 32, "secret"),
]
WEAK = [
    (
        "weak_identifier",
        r"""(?i:username|user|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
        0, 3, "identifier",
    ),
    (
        "weak_secret",
        r"""(?i:passphrase|pass|pwd|credentials?)["']?\x20*[:=]\x20*["']?[^\x20\x09-\x0D"']{4,}"""
        r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}",
        0, 4, "secret",
    ),
    (
        "weak_endpoint",
        r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]{3,}|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}:[0-9]{2,5}(?![0-9])""",
        0, 3, "endpoint",
    ),
]
KINDS = BASE + WEAK
NAMES = [k[0] for k in KINDS]
BASE_KINDS = len(BASE)


def _lengths(text: Column, number: int) -> Column:
    """Array of (kind, nth, gap, length, ok): each match and the text before it."""
    _, pattern, group, least, _ = KINDS[number]
    regexp = F.lit(pattern)
    matches = F.regexp_extract_all(text, regexp, F.lit(0))
    values = F.regexp_extract_all(text, regexp, F.lit(group))
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), matches.alias("whole"), (values if group else matches).alias("value")
    )
    found = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("nth"),
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["whole"]).cast("long").alias("length"),
            (F.length(x["value"]) >= least).alias("ok"),
        ),
    )
    # what follows the last match has no match of its own
    return F.when(text.rlike(pattern), F.filter(found, lambda x: x["length"].isNotNull()))


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (row_id, doc_id) of the documents, and (row_id, kind, start, end, role) of their matches."""
    none = F.array().cast("array<struct<kind:int,nth:int,gap:bigint,length:bigint,ok:boolean>>")
    # row_id tells repeated rows apart; the table is written, so it stays the same
    scanned = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.concat(*(F.coalesce(_lengths(F.col("text"), k), none) for k in range(len(KINDS)))).alias("found"),
        ),
        "secret-lengths",
    )
    before = Window.partitionBy("row_id", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    roles = F.array(*(F.lit(k[4]) for k in KINDS))
    placed = (
        scanned.select("row_id", F.explode("found").alias("m"))
        .select("row_id", "m.*")
        .withColumn("start", F.col("gap") + F.coalesce(F.sum(F.col("gap") + F.col("length")).over(before), F.lit(0)))
        .filter("ok")
        .select(
            "row_id", "kind", "start", (F.col("start") + F.col("length")).alias("end"),
            F.element_at(roles, F.col("kind") + 1).alias("role"),
        )
    )
    return scanned.select("row_id", "doc_id"), stored(placed, "secret-spans")


def _binned(parts: DataFrame, reach: int) -> DataFrame:
    first = F.floor((F.col("start") - reach) / BIN)
    last = F.floor((F.col("end") + reach) / BIN)
    return parts.withColumn("bin", F.explode(F.sequence(first, last)))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans that a complementary part supports."""
    weak = found.filter(F.col("kind") >= BASE_KINDS)
    overlap = (F.col("p.row_id") == F.col("q.row_id")) & (F.col("p.bin") == F.col("q.bin"))
    apart = lambda reach: (F.col("q.start") < F.col("p.end") + reach) & (F.col("q.end") > F.col("p.start") - reach)
    strong = _binned(found.filter(F.col("kind") < BASE_KINDS), 0).alias("q")
    covered = _binned(weak, 0).alias("p").join(strong, overlap & apart(0), "left_semi").select("row_id", "kind", "start").distinct()
    own = weak.join(covered, ["row_id", "kind", "start"], "left_anti")
    parts = own.unionByName(found.filter(F.col("kind") < BASE_KINDS))
    # exactly one of the two is a secret
    complementary = (F.col("p.role") == "secret") != (F.col("q.role") == "secret")
    supported = _binned(own, scope).alias("p").join(
        _binned(parts, 0).alias("q"), overlap & apart(scope) & complementary, "left_semi"
    )
    return supported.select("row_id", "kind", "start", "end", "role").distinct()


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, spans) of every document: its spans as sorted (start, kind, end) structs,
    ``kind`` as an index into :data:`NAMES`."""
    rows, found = spans(docs)
    all_spans = found.filter(F.col("kind") < BASE_KINDS).unionByName(stored(linked(found, scope), "secret-linked"))
    listed = all_spans.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(listed, "row_id", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _joined(spans_: Column) -> Column:
    names = F.array(*(F.lit(n) for n in NAMES))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans_, one), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(count(k).alias(f"n_{NAMES[k]}") for k in range(BASE_KINDS)),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
