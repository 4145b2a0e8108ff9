import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    """Every row is a vector of its own, also if its id or all of it is repeated."""
    fine = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, tuple(math.floor(256 * float(x)) for x in v)))
    out = []
    for a, (i, q) in enumerate(fine):
        if i % every == 0:
            scores = [(-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(fine) if a != b and len(v) == len(q)]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def check(df):
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk.top_k(topk.scaled(df), F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


@pytest.fixture(params=["small", "one"])
def blocks(request, monkeypatch):
    if request.param == "small":
        for name, value in {"BLOCK_VECTORS": 60, "BLOCK_QUERIES": 3, "CHUNK_NUMBERS": 500, "SAMPLED": 3, "HELD_CANDIDATES": 10, "CELLS": 4}.items():
            monkeypatch.setattr(topk, name, value)


def test_generated(spark, sf_dir, blocks):
    check(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def hard_vectors():
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25]) for _ in range(4)], 0) for i in range(200)]  # ties and copies
    rows += [(300 + i, [0.5] * 4, 1) for i in range(80)]
    rows += [(1000, None, 0), (1050, [1.0, None, 1.0, 1.0], 0), (1100, [float("nan")] * 4, 0), (1150, [float("inf")] * 4, 0)]
    rows += [(1200, [], 0), (1250, [0.1] * 3, 0), (1251, [0.2] * 3, 0), (1300, [9.0] * 7, 0), (None, [1.0] * 4, 0)]
    rows += [(50, rows[50][1], 0), (1301, [3e6, -3e6, 1e6, 7.0], 0), (1350, [2e6, 1e6, -5e6, 0.3], 0)]
    rows += [(100, [0.75, 0.5, 0.5, 0.5], 0), (100, [0.75, -0.5, 0.5, 0.5], 0)]  # one id, several vectors
    return rows + [(150, [0.5] * 4, 0)] * 9  # and a row repeated


def test_hard_vectors(spark, blocks):
    check(spark.createDataFrame(hard_vectors(), SCHEMA).repartition(4))


def test_clashing_columns(spark):
    df = spark.createDataFrame(hard_vectors()[:120], SCHEMA)
    for name in ("row", "dim", "v", "block", "chunk", "lower", "upper", "query_row", "score", "rank", "place", "turn"):
        df = df.withColumn(name, F.lit("clash"))
    check(df)


def test_empty(spark):
    check(spark.createDataFrame([], SCHEMA))


def test_fewer_than_k(spark):
    check(spark.createDataFrame([(50 * i, [0.5, i / 7], 0) for i in range(3)], SCHEMA))


def test_bounds_hold():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    exact = rng.integers(-3000, 3000, (500, 8))
    part = pa.table({"row": np.arange(500), "vec_id": np.arange(500), "v": pa.array(exact.tolist(), pa.list_(pa.int64()))})
    packed = topk.pack_cells((pa.scalar(8, pa.int32()), pa.scalar(0, pa.int64())), part)
    cells = topk.Cells(8, *(packed.column(c)[0].as_py() for c in ("rows", "ids", "codes", "low", "step")))
    queries = rng.integers(-300, 300, (20, 8))
    lower, upper = cells.bounds(queries)
    score = queries @ exact.T
    assert (lower <= score).all() and (score <= upper).all()
    assert np.mean(upper - lower) < np.std(score) / 4  # and they are close


def test_what_moves_grows_with_the_table(spark, tmp_path):
    """Candidates of all queries, at two sizes: linear in the vectors, not quadratic."""
    rng = np.random.default_rng(3)
    found = []
    for n in (4_000, 16_000):
        x = rng.normal(size=(n, 16)) / 4
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))], SCHEMA)
        vectors = topk.scaled(df).withColumn("row", F.col("vec_id"))
        cells = vectors.withColumn("block", F.col("row") % (n // 500)).groupBy("dim", "block").applyInArrow(topk.pack_cells, topk.CELL_BLOCKS)
        asked = topk.chunk_of(vectors.filter("vec_id % 50 = 0").withColumn("chunk", F.lit(0)), 0)
        lowest = {d: (r, v, np.full(len(r), topk.LOWEST)) for d, (r, v) in asked.items()}
        known = topk.floors_of(topk.scan_blocks(cells.filter("block % 4 = 0"), lowest, 5), 5)
        floored = {d: (r, v, np.array([known[i] for i in r.tolist()])) for d, (r, v) in asked.items()}
        found.append(topk.scan_blocks(cells, floored, 5).count() / len(known))
    assert found[1] < 2 * found[0] and found[0] < 60  # per query
