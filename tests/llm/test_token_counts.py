import random

import pytest
from pyspark.sql import functions as F

from tablesync.llm import token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoding():
    return token_counts.vocabulary_encoding(PATH, PATTERN)


def applied(text, edits):
    for position, deleted, inserted in edits:
        position = min(max(position, 0), len(text))
        text = text[:position] + inserted + text[position + max(deleted, 0) :]
    return text


def test_any_edit_matches_a_full_count(monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF_CHARS", 12)
    monkeypatch.setattr(token_counts.leaves, "__defaults__", (12,))
    rng = random.Random(7)
    pieces = ["a", "word", " ", "  ", "\n", "\t ", "'s", "'", "don't", "42", "...", "é", "　", "\xa0", "\U0001f600", " the", "\x85"]
    count = lambda t: len(encoding().encode_ordinary(t))
    for _ in range(300):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 60)))
        parts = token_counts.leaves(text)
        assert "".join(parts) == text and sum(map(count, parts)) == count(text)
        tree = token_counts.Tree([len(p) for p in parts], [count(p) for p in parts])
        for _ in range(8):
            e = (rng.randint(-2, len(text) + 3), rng.choice([0, 0, 1, 3, 25]), "".join(rng.choices(pieces, k=rng.choice([0, 1, 2, 15]))))
            want = applied(text, [e])
            tree, text, _ = token_counts.edit(tree, text, *e, count)
            assert text == want
            assert tree.tokens[1] == count(text) and tree.chars[1] == len(text)


def test_documents(documents, edge_docs, empty_docs, with_clashes):
    for docs in (documents, with_clashes(edge_docs), empty_docs):
        edited = token_counts.derived_edits(docs)
        trees = token_counts.build_trees(docs, PATH, PATTERN)
        got = token_counts.apply_edits(edited, trees, PATH, PATTERN).collect()
        count = lambda t: len(encoding().encode_ordinary(t))
        want = []
        for r in edited.collect():
            after = applied(r.text or "", [(e.position or 0, e.deleted or 0, e.inserted or "") for e in r.edits])
            want.append((r.doc_id, count(r.text or ""), count(after), len(after)))
        assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(want, key=str)
        for r in got:
            assert r.n_reencoded <= max(r.n_chars_after + 200, 9 * token_counts.LEAF_CHARS) * 3


def test_long_documents_are_encoded_in_part(spark):
    text = "some words in a row, and more of them. " * 5000
    docs = spark.createDataFrame([(1, text, [(90_000, 5, "xyz")])], f"doc_id long, text string, edits {token_counts.EDITS}")
    trees = token_counts.build_trees(docs, PATH, PATTERN)
    (r,) = token_counts.apply_edits(docs, trees, PATH, PATTERN).collect()
    assert r.n_reencoded < 3 * token_counts.LEAF_CHARS < r.n_chars_after / 50


def test_null_edits(spark):
    docs = spark.createDataFrame(
        [(None, "a b c", None), (2, None, [(None, None, None), None, (0, 9, "x y")])], f"doc_id long, text string, edits {token_counts.EDITS}"
    )
    trees = token_counts.build_trees(docs, PATH, PATTERN)
    got = {r.doc_id: (r.n_tokens, r.n_tokens_after) for r in token_counts.apply_edits(docs, trees, PATH, PATTERN).collect()}
    assert got == {None: (3, 3), 2: (0, 2)}


@pytest.mark.parametrize("size", [1, 7, 64])
def test_many_edits_at_once_match_a_full_count(monkeypatch, size):
    monkeypatch.setattr(token_counts.leaves, "__defaults__", (size,))
    rng = random.Random(size)
    pieces = ["a", "word", " ", "  ", "\n", "\t ", "'s", "don't", "42", "...", "é", "　", "\xa0", "\U0001f600", " the", "\x85", "\x1c"]
    count = lambda t: len(encoding().encode_ordinary(t))
    for _ in range(200):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 120)))
        parts = token_counts.leaves(text)
        counts = token_counts.leaf_tokens(encoding(), text, parts)
        assert counts.tolist() == [count(p) for p in parts]
        tree = token_counts.Tree([len(p) for p in parts], counts)
        for _ in range(3):
            edits = [
                (rng.randint(-2, len(text) + 3), rng.choice([0, 0, 1, 3, 25]), "".join(rng.choices(pieces, k=rng.choice([0, 1, 2, 15]))))
                for _ in range(rng.randint(0, 6))
            ]
            want = applied(text, edits)
            tree, text, again = token_counts.make_edits(tree, text, edits, count)
            assert text == want and again <= len(text)  # nothing is encoded twice
            assert tree.tokens[1] == count(text) and tree.chars[1] == len(text)


def test_a_small_share_is_encoded_again(spark, documents):
    trees = token_counts.build_trees(documents, PATH, PATTERN)
    rows = token_counts.apply_edits(token_counts.derived_edits(documents), trees, PATH, PATTERN).collect()
    share = sum(r.n_reencoded for r in rows) / sum(r.n_chars_after for r in rows)
    assert share < 0.25, share
    assert all(r.n_reencoded <= r.n_chars_after for r in rows)
