import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tablesync.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def remainder(c):
    return c - (abs(c) % 100) * (1 if c >= 0 else -1)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(remainder(c), [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        cost = (len(m) - 1) * len(k[-1][1]) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += cost
            leaves[k[:d]] += k not in children
    return sorted(
        (
            (
                min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest(),
            )
            for k, m in members.items()
        ),
        key=str,
    )


def result(df):
    rows = trie.prefix_trie(*trie.rebuilt(df)).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in rows), key=str)


def hard_rows():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 12), *range(100, 125), *range(300, 330), -1, -100, -101, -107]:  # 200 to 299 have no base
        for turn in range(rng.randint(1, 5)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["same", "ä\U0001f600", "", "x" * 30])))
    rows += [(250, 0, "user", "no base"), (251, 0, "user", "no base"), (252, 9, None, None)]
    rows += [(100, 1, "user", "tie"), (100, 1, "assistant", "tie"), (100, 1, "assistant", "tie")]  # ties and a repeated row
    rows += [(101, None, "user", "null turn"), (101, -5, "user", "negative turn"), (102, 1 << 40, "user", None)]
    rows += [(None, 0, "user", "no conversation"), (None, None, None, None)]
    rows += [(400, t, "user", f"t{t % 7}") for t in range(60)] + [(401, t, "user", f"t{t % 7}") for t in range(55)]
    rows += [(c, 0, "a:b", "c") for c in (500, 501)] + [(502, 0, "a", "b:c")]  # no sequence runs into another
    return rows


@pytest.fixture(params=["blocks", "one"])
def blocks(request, monkeypatch):
    if request.param == "blocks":  # conversations, depths and end lists over many blocks
        monkeypatch.setattr(trie, "TURN_BITS", 2)
        monkeypatch.setattr(trie, "DEPTH_BITS", 2)
        monkeypatch.setattr(trie, "ID_BITS", 3)


def test_hard_conversations(spark, blocks):
    rows = hard_rows()
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_empty_and_null_only(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_extra_columns_and_turnless(spark):
    rows = [(c, 0, "user", "gone") for c in range(201, 220)]  # no base, so those with h > 0 have no turn
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "pos", "d", "block", "key", "weight", "leaf", "n", "total", "digest", "chars", "a", "b"):
        df = df.withColumn(name, F.lit("clash"))
    got = result(df)
    assert got == brute(rows) and any(r[1] == 0 and r[7] != trie.EMPTY_SHA256 for r in got)


def test_generated_equals_sql(spark, sf_dir):
    got = result(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM '{sf_dir}/conversations.parquet'")
    want = con.sql(trie.ORACLE)
    at = [want.columns.index(c) for c in COLUMNS]
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)
