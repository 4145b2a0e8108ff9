from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tablesync.llm import line_dedup, mixing, packing, quality, simhash
from tablesync.llm.common import stored

pytest.importorskip("public_tokenizers")
STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows after every stage, and the last stage's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], sf_dir), "test-pipeline"))
    return seen


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_rules(stages):
    good = {r.doc_id for r in quality.verdicts(stages[0]).collect() if r.kept}
    assert sorted(rows_of(stages[1])) == sorted(r for r in rows_of(stages[0]) if r[0] in good)
    assert 0 < len(good) < stages[0].count()


def test_line_dedup(stages):
    before = rows_of(stages[1])
    key = lambda x: x.strip(STRIP).translate(LOWER)
    first = {}
    for i, text, *_ in before:
        for line in text.split("\n"):
            first[key(line)] = min(first.get(key(line), i), i)
    want = []
    for i, text, lang, source, _ in before:
        left = "\n".join(x for x in text.split("\n") if len(key(x)) < 10 or first[key(x)] == i)
        want.append((i, left, lang, source, len(left)))
    assert sorted(rows_of(stages[2])) == sorted(want)


def test_near_dedup(stages):
    before = rows_of(stages[2])
    prints = [simhash.fingerprint(r[1]) for r in before]
    root = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [a if x == b else x for x in root]
    groups = defaultdict(list)
    for r, row in zip(root, before):
        groups[r].append(row)
    assert sorted(rows_of(stages[3])) == sorted(min(g) for g in groups.values())


def test_mixing(stages):
    taken = {r.doc_id: r.taken for r in mixing.mix(stages[3]).collect()}
    sizes = {r[0]: len((r[1] or "").encode().split()) for r in rows_of(stages[3])}
    copies = Counter(r[0] for r in rows_of(stages[4]))
    assert all(copies[i] * sizes[i] == taken[i] for i in sizes)


def test_packing(stages):
    before = rows_of(stages[4])
    got = stages[5].collect()
    encode = packing.WordEncoder(__import__("public_tokenizers").path("word_bpe_49k.json"))
    tokens = defaultdict(int)
    for r in got:
        tokens[r.doc_id] += r.length
    want = defaultdict(int)
    for r, ids in zip(before, encode([r[1] for r in before])):
        want[r[0]] += len(ids) // 4
    assert tokens == want
    full = Counter()
    for r in got:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 4096 and len(full) <= sum(want.values()) / 4096 * 1.02 + 1


def test_run(spark, sf_dir, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).select(*columns).collect()))
    assert got == Counter(map(tuple, stages[5].select(*columns).collect()))


def test_hard_documents(spark, edge_docs, empty_docs, sf_dir):
    """Every stage over nulls, empty texts, repeated rows and no rows at all."""
    for docs in (edge_docs, empty_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf_dir), "test-hard")
        assert docs.columns[0] == "doc_id"
