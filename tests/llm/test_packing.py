import zlib
from collections import defaultdict

import numpy as np
import pytest

from tablesync.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = []
    for (doc, _), ids in zip(rows, ids_of([t for _, t in rows])):
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            want.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = packing.pack_documents(docs).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences), sum(x[3] for x in want)


def test_pieces_and_places(documents, edge_docs, empty_docs, with_clashes):
    n, total = check(documents)
    assert n <= total / 4096 * 1.02 + 1
    check(with_clashes(edge_docs))
    assert packing.pack_documents(empty_docs).count() == 0


def test_many_rounds(spark):
    items = spark.range(5000).selectExpr(
        "cast(1 + id * 37 % 2000 as int) AS size",
        "cast(lpad(cast(id as string), 29, '0') as binary) AS members",
    )
    bins = packing.pack(items, 4096, items_per_task=300).collect()
    total = sum(1 + i * 37 % 2000 for i in range(5000))
    assert sum(len(b.members) for b in bins) == 5000 * 29
    assert len({b.bin for b in bins}) == len(bins) and max(b.size for b in bins) <= 4096
    assert len(bins) <= total / 4096 * 1.01 + 1


def test_items_that_never_share(spark):
    items = spark.range(1000).selectExpr(
        "3000 AS size", "cast(lpad(cast(id as string), 29, '0') as binary) AS members"
    )
    assert packing.pack(items, 4096, items_per_task=100).count() == 1000


def test_words_encode_as_whole_texts():
    words = (
        "Plain wörd, Straße. ÀÉÎõü!! don't it's 12.5 a1b2 ÷×µª ﬁne ﬁ İstanbul ΣΑΣ éa É, İx ﬀ <|endoftext|> <|ENDOFTEXT|> "
        "x<|startoftext|>y ́a .,;: ... !? a.b a,b, 你好。 \U0001f600. naïve… –— \x00 \x85z  q ÿ Ÿ ſ ŉ K Å"
    )
    texts = [words, words.lower(), words.upper(), words.replace(" ", "\n\t "), "".join(words.split()), "", " \n"]
    texts += words.split(" ")
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))(texts)]
    assert got == ids_of(texts)
