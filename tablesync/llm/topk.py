"""Exact top-k search with vector-approximation files.

Two files hold the vectors: the *cells*, packed in blocks (for every dimension 256 equal
cells between the block's smallest and largest value, one byte a component), and the
*exact* vectors, one row each.  A cell bounds the score of all vectors in it: with the
cell's middle ``m`` and half width ``h``, an inner product lies within ``q.m`` plus or
minus ``|q|.h``.

1. A bounded chunk of queries at a time goes to the blocks of cells, which stay where they
   are.  A few blocks are scanned first: the k-th largest lower bound found there is a score
   that the query's result cannot fall below.  The scan of all blocks then returns only
   vectors whose upper bound reaches it, and a task raises it as it goes.
2. Over all that was returned, a query's k-th largest lower bound is final; what cannot
   reach it goes.  The exact vectors of the k candidates of the largest upper bounds are
   read, then those of the others whose upper bound reaches the k-th exact score, so the
   result is exact.

No cell and no vector is shuffled to a query: what moves are the queries (to the tasks,
``CHUNK_NUMBERS`` components at a time), candidates, and exact vectors of candidates.

Defined results: vectors that are null, empty or hold null or non-finite components,
and rows without an id, take no part; every row is a vector of its own, so repeated rows
and rows that share an id are queries of their own and one another's candidates; only
vectors of the query's length are candidates; ties go to the smaller id; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table

K = 5
SCALE = 256
QUERY_EVERY = 50
CELLS = 256
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 256  # queries whose bounds a task holds at once
CHUNK_NUMBERS = 1 << 20  # components of the queries that are sent to the tasks at once
SAMPLED = 64  # one block in so many is scanned for the first floors
HELD_CANDIDATES = 1 << 18  # candidates a task holds before it passes them on
EXACT_FLOAT = float(1 << 53)
LOWEST = int(np.iinfo(np.int64).min)

CELL_BLOCKS = "dim int, block long, rows binary, ids binary, codes binary, low binary, step binary"
CANDIDATES = "query_row long, row long, vec_id long, lower long, upper long"


def scaled(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, v): the vectors that take part, in whole numbers."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
        .select("vec_id", F.size("embedding").alias("dim"), F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))
    )


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of whole numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT_FLOAT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def pack_cells(key, part):
    """A block of vectors -> one row: row numbers, ids and cells."""
    dim = key[0].as_py()
    part = part.combine_chunks()
    exact = matrix(part.column("v").combine_chunks(), dim)
    low = exact.min(axis=0)
    step = np.maximum(1, -(-(exact.max(axis=0) - low + 1) // CELLS))
    codes = ((exact - low) // step).astype(np.uint8)
    row = {"dim": [dim], "block": [key[1].as_py()]}
    for name, x in (("rows", part.column("row").to_numpy()), ("ids", part.column("vec_id").to_numpy()), ("codes", codes), ("low", low), ("step", step)):
        row[name] = [np.ascontiguousarray(x).tobytes()]
    return pa.table(row, schema=pa.schema([("dim", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("rows", "ids", "codes", "low", "step")]))


class Cells:
    """A block of cells, opened."""

    def __init__(self, dim: int, rows: bytes, ids: bytes, codes: bytes, low: bytes, step: bytes):
        self.rows, self.ids = np.frombuffer(rows, "<i8"), np.frombuffer(ids, "<i8")
        self.low, self.step = np.frombuffer(low, "<i8"), np.frombuffer(step, "<i8")
        self.codes = np.frombuffer(codes, np.uint8).reshape(-1, dim).astype(np.int64)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of all queries and vectors of the block."""
        first = self.low + self.codes * self.step
        # doubled, so that middles are whole numbers: a cell is first .. first + step - 1
        middle = product(queries, 2 * first + self.step - 1)
        reach = product(np.abs(queries), (self.step - 1)[None, :])
        return (middle - reach) // 2, -((-(middle + reach)) // 2)


class Asked:
    """The queries of one length in a chunk, with the floors known so far."""

    def __init__(self, rows: np.ndarray, values: np.ndarray, floors: np.ndarray, k: int):
        self.rows, self.values, self.k = rows, values, k
        self.floors = floors.copy()
        self.best = np.full((len(rows), k), LOWEST)  # largest lower bounds met here
        self.held: list[np.ndarray] = []  # query, row, id, lower, upper
        self.n_held = 0

    def scan(self, cells: Cells) -> None:
        for at in range(0, len(self.rows), BLOCK_QUERIES):
            part = slice(at, at + BLOCK_QUERIES)
            lower, upper = cells.bounds(self.values[part])
            own = self.rows[part][:, None] == cells.rows[None, :]
            lower[own] = upper[own] = LOWEST
            n = min(self.k, lower.shape[1])
            top = np.partition(lower, lower.shape[1] - n, axis=1)[:, lower.shape[1] - n :]
            best = np.sort(np.concatenate([self.best[part], top], axis=1), axis=1)[:, -self.k :]
            self.best[part] = best
            self.floors[part] = np.maximum(self.floors[part], best[:, 0])
            query, vector = np.nonzero((upper >= self.floors[part][:, None]) & (upper > LOWEST))
            self.held.append(np.stack([query + at, cells.rows[vector], cells.ids[vector], lower[query, vector], upper[query, vector]]))
            self.n_held += len(query)

    def candidates(self) -> np.ndarray:
        """What is held and still reaches its query's floor; nothing is held any more."""
        found = np.concatenate(self.held, axis=1) if self.held else np.zeros((5, 0), np.int64)
        self.held, self.n_held = [], 0
        found = found[:, found[4] >= self.floors[found[0]]]
        found[0] = self.rows[found[0]]
        return found


def scan_blocks(cells: DataFrame, asked: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """Candidates of a chunk of queries {dim: (rows, values, floors)} in blocks of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = {dim: Asked(*x, k) for dim, x in asked.items()}
        names = [c.split()[0] for c in CANDIDATES.split(", ")]
        out = lambda x: pa.RecordBatch.from_arrays([pa.array(c) for c in x.candidates()], names)
        for batch in batches:
            for dim, *block in zip(*(c.to_pylist() for c in batch.columns)):
                if dim in mine:
                    mine[dim].scan(Cells(dim, *block))
                    if mine[dim].n_held > HELD_CANDIDATES:
                        yield out(mine[dim])
        for x in mine.values():
            yield out(x)

    return cells.select("dim", "rows", "ids", "codes", "low", "step").mapInArrow(run, CANDIDATES)


def chunk_of(queries: DataFrame, chunk: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The queries of one chunk on the driver: about CHUNK_NUMBERS components."""
    by_dim: dict[int, list] = {}
    for r in queries.filter(F.col("chunk") == chunk).select("row", "dim", "v").collect():
        by_dim.setdefault(r["dim"], []).append((r["row"], r["v"]))
    return {d: (np.array([i for i, _ in x], np.int64), np.array([v for _, v in x], np.int64)) for d, x in by_dim.items()}


def floors_of(found: DataFrame, k: int) -> dict[int, int]:
    """The k-th largest lower bound of each query of a chunk."""
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("lower").desc()))
    return {r[0]: r[1] for r in found.withColumn("place", place).filter(F.col("place") == k).select("query_row", "lower").collect()}


def exact_scores(candidates: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Candidates with their exact score: both vectors are read by an equality join."""
    products = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda total, x: total + x)
    return (
        candidates.join(vectors.select("row", "v"), "row")
        .join(queries.select(F.col("row").alias("query_row"), F.col("v").alias("q")), "query_row")
        .select(*candidates.columns, products.alias("score"))
    )


def top_k(vectors: DataFrame, queries, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query.

    ``vectors`` is (vec_id, dim, v) as from :func:`scaled`; ``queries`` is the condition
    on ``vec_id`` that makes a row a query.
    """
    vectors = stored(vectors.select("vec_id", "dim", "v").withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = max(1, -(-vectors.count() // BLOCK_VECTORS))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    cells = stored(
        vectors.withColumn("block", block).groupBy("dim", "block").applyInArrow(pack_cells, CELL_BLOCKS), "vector-cells"
    )
    asking = vectors.filter(queries)
    chunks = max(1, -(-(asking.agg(F.sum("dim")).first()[0] or 0) // CHUNK_NUMBERS))
    asking = stored(asking.withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks))), "vector-queries")
    found = None
    for chunk in range(chunks):
        asked = chunk_of(asking, chunk)
        lowest = {d: (rows, values, np.full(len(rows), LOWEST)) for d, (rows, values) in asked.items()}
        known = floors_of(scan_blocks(cells.filter(F.col("block") % SAMPLED == 0), lowest, k), k)
        floored = {
            d: (rows, values, np.array([known.get(r, LOWEST) for r in rows.tolist()], np.int64)) for d, (rows, values) in asked.items()
        }
        part = stored(scan_blocks(cells, floored, k), "vector-candidates")
        found = part if found is None else found.unionByName(part)

    by_query = Window.partitionBy("query_row")
    place = F.row_number().over(by_query.orderBy(F.col("lower").desc(), "row"))
    floor = F.max(F.when(F.col("place") == k, F.col("lower"))).over(by_query)
    reaching = found.withColumn("place", place).withColumn("floor", F.coalesce(floor, F.lit(LOWEST))).filter("upper >= floor")
    # exact vectors in the order of their bounds: k at first, then what can still reach the k-th score
    order = F.row_number().over(by_query.orderBy(F.col("upper").desc(), "row"))
    reaching = stored(reaching.withColumn("turn", order).select("query_row", "row", "vec_id", "upper", "turn"), "vector-candidates")
    first = stored(exact_scores(reaching.filter(F.col("turn") <= k), vectors, asking), "vector-scores")
    kth = first.groupBy("query_row").agg(F.min("score").alias("kth"))
    others = reaching.filter(F.col("turn") > k).join(kth, "query_row").filter("upper >= kth").drop("kth")
    scores = first.unionByName(exact_scores(others, vectors, asking))
    rank = F.row_number().over(by_query.orderBy(F.col("score").desc(), "vec_id"))
    ids = asking.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    ranked = scores.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.join(ids, "query_row").select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(scaled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % QUERY_EVERY == 0)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row <> c.row AND len(q.x) = len(c.x)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""
