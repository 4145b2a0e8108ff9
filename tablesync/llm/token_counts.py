"""Token counts that follow edits, by segment trees over pre-token runs.

The pre-tokenizer never puts a character and white space after it into one
pre-token, and looks no further back than its own start.  Text may therefore be cut
before any white space that follows another character, and the parts' counts add up.
A document is cut there into leaves of about ``LEAF_CHARS`` code points, a few pre-tokens
each; its tree holds, for every node, the code points and the tokens below it, and is
kept in a table.  A document is encoded once to build it: the leaves' tokens are counted
by the bytes they end at.

An edit finds its leaves by descending the code-point sums and marks them.  Once all edits
of a document are made, each run of marked leaves is one region: it takes in neighbours
until both ends are safe cuts in the edited text (the boundary context), is encoded once,
and the sums on its leaves' paths are updated.  Nothing outside the regions is encoded.

Defined results: a null or empty text has 0 tokens and one empty leaf; positions and
lengths beyond the text are cut to it; a null position is 0, a null insertion is
empty, null edits are none; a null ``doc_id`` stays null; repeated rows are counted one
by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table, text_slices

LEAF_CHARS = 64
CUT = re.compile(r"(?<=\S)(?=\s)")
EDITS = "array<struct<position:bigint,deleted:bigint,inserted:string>>"
TREES = "doc_id long, text_hash long, chars binary, tokens binary"
COUNTS = "doc_id long, n_tokens long, n_tokens_after long, n_chars_after long, n_reencoded long, n_leaves long"


def vocabulary_encoding(path: str, pattern: str):
    """One encoding a Python worker, kept from task to task in a module of its own."""
    kept = sys.modules.setdefault("_byte_encodings", types.ModuleType("_byte_encodings")).__dict__
    if path not in kept:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        kept[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def token_bytes(encoding) -> np.ndarray:
    """Bytes of every token, kept beside the encoding in a Python worker."""
    kept = sys.modules["_byte_encodings"].__dict__.setdefault("sizes", {})
    if id(encoding) not in kept:
        kept[id(encoding)] = np.array([len(encoding.decode_single_token_bytes(k)) for k in range(encoding.n_vocab)], np.int64)
    return kept[id(encoding)]


def leaf_tokens(encoding, text: str, parts: list[str]) -> np.ndarray:
    """Tokens of each leaf of a text: no token crosses a leaf's end."""
    if len(parts) == 1:
        return np.array([len(encoding.encode_ordinary(text))], np.int64)
    ends = np.cumsum(token_bytes(encoding)[encoding.encode_ordinary(text)])
    cuts = np.cumsum([len(p.encode()) for p in parts])
    return np.diff(np.searchsorted(ends, cuts, side="right"), prepend=0)


def leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """``text`` cut at the first safe place after every ``size`` code points."""
    out, start = [], 0
    while len(text) - start > size:
        cut = CUT.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


class Tree:
    """Sums of code points and tokens over the leaves, in heap order."""

    def __init__(self, chars, tokens):
        self.n = len(chars)
        self.width = 1 << max(0, (self.n - 1).bit_length())
        self.chars, self.tokens = (self._sums(x) for x in (chars, tokens))

    def _sums(self, values) -> np.ndarray:
        out = np.zeros(2 * self.width, np.int64)
        out[self.width : self.width + self.n] = values
        for level in reversed(range(self.width.bit_length() - 1)):
            at = 1 << level
            out[at : 2 * at] = out[2 * at : 4 * at : 2] + out[2 * at + 1 : 4 * at : 2]
        return out

    def leaf_values(self) -> tuple[np.ndarray, np.ndarray]:
        return self.chars[self.width : self.width + self.n], self.tokens[self.width : self.width + self.n]

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position, and where it starts; the last one for the end."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position - start >= self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return min(node - self.width, self.n - 1), start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Sets a leaf and the sums on its path."""
        node = self.width + leaf
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2


def make_edits(tree: Tree, text: str, edits, count) -> tuple[Tree, str, int]:
    """All edits (position, deleted, inserted) in order -> (tree, text, code points encoded again)."""
    marked: set[int] = set()
    for position, deleted, inserted in edits:
        position = min(max(position, 0), len(text))
        end = min(position + max(deleted, 0), len(text))
        if position == end and not inserted:
            continue
        first, _ = tree.find(position)
        last, _ = tree.find(max(position, end - 1))
        held = int(tree.chars[tree.width + first : tree.width + last + 1].sum())
        tree.put(first, held + len(inserted) - (end - position), 0)
        for leaf in range(first + 1, last + 1):
            tree.put(leaf, 0, 0)
        marked.update(range(first, last + 1))
        text = text[:position] + inserted + text[end:]
    if not marked:
        return tree, text, 0
    chars, tokens = tree.leaf_values()
    starts = np.concatenate([[0], np.cumsum(chars)]).tolist()
    safe = lambda at: at in (0, len(text)) or (not text[at - 1].isspace() and text[at].isspace())
    regions: list[list[int]] = []  # first and last leaf
    for leaf in sorted(marked):
        if regions and leaf <= regions[-1][1]:
            continue
        first = last = leaf
        while not safe(starts[first]):
            first -= 1
        while last + 1 < tree.n and (last + 1 in marked or not safe(starts[last + 1])):
            last += 1
        if regions and first <= regions[-1][1] + 1:
            regions[-1][1] = last
        else:
            regions.append([first, last])
    parts = [leaves(text[starts[a] : starts[b + 1]]) for a, b in regions]
    again = sum(starts[b + 1] - starts[a] for a, b in regions)
    if all(len(p) <= b - a + 1 for p, (a, b) in zip(parts, regions)):
        for found, (a, b) in zip(parts, regions):
            for k in range(b - a + 1):
                part = found[k] if k < len(found) else ""
                tree.put(a + k, len(part), count(part))
        return tree, text, again
    # more leaves than before: their counts are kept, the sums are laid out anew
    chars, tokens = chars.tolist(), tokens.tolist()
    for found, (a, b) in reversed(list(zip(parts, regions))):
        chars[a : b + 1] = [len(p) for p in found]
        tokens[a : b + 1] = [count(p) for p in found]
    return Tree(chars, tokens), text, again


def edit(tree: Tree, text: str, position: int, deleted: int, inserted: str, count) -> tuple[Tree, str, int]:
    """One edit -> (tree, text, code points encoded again)."""
    return make_edits(tree, text, [(position, deleted, inserted)], count)


def packed(values) -> bytes:
    """Small whole numbers, in as few bytes each as the largest needs; its first byte says how many."""
    values = np.asarray(values)
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text_hash", F.xxhash64("text"))


def build_trees(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, text_hash, chars, tokens): the leaves of every document's tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary_encoding(vocabulary, pattern)
        for batch in text_slices(batches):
            chars, tokens = [], []
            for text in batch.column(2).to_pylist():
                parts = leaves(text or "")
                chars.append(packed([len(p) for p in parts]))
                tokens.append(packed(leaf_tokens(encoding, text or "", parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(chars, pa.binary()), pa.array(tokens, pa.binary())],
                names=["doc_id", "text_hash", "chars", "tokens"],
            )

    return _keyed(docs.select("doc_id", "text")).select("doc_id", "text_hash", "text").mapInArrow(run, TREES)


def apply_edits(docs: DataFrame, trees: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Counts before and after the ``edits`` (an array column of ``docs``, applied in order)."""
    rows = _keyed(docs.select("doc_id", "text", F.col("edits").cast(EDITS).alias("edits")))
    kept = trees.dropDuplicates(["doc_id", "text_hash"]).select(
        F.col("doc_id").alias("tree_id"), F.col("text_hash").alias("tree_hash"), "chars", "tokens"
    )
    joined = rows.join(kept, rows["doc_id"].eqNullSafe(kept["tree_id"]) & (rows["text_hash"] == kept["tree_hash"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary_encoding(vocabulary, pattern).encode_ordinary
        count = lambda part: len(encode(part))
        for batch in text_slices(batches):
            out = []
            for text, edits, chars, tokens in zip(*(c.to_pylist() for c in batch.columns[1:])):
                text = text or ""
                tree = Tree(unpacked(chars), unpacked(tokens))
                before = int(tree.tokens[1])
                wanted = [(e["position"] or 0, e["deleted"] or 0, e["inserted"] or "") for e in edits or [] if e is not None]
                tree, text, again = make_edits(tree, text, wanted, count)
                out.append((before, int(tree.tokens[1]), len(text), again, tree.n))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "n_tokens", "n_tokens_after", "n_chars_after", "n_reencoded", "n_leaves"],
            )

    return joined.select("doc_id", "text", "edits", "chars", "tokens").mapInArrow(run, COUNTS)


def derived_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with three edits each, taken from the document itself: a deletion, a
    moved passage and a replaced character, at places hashed from its id."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    at = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), n + 1)
    one = lambda position, deleted, inserted: F.struct(
        position.alias("position"), F.lit(deleted).cast("long").alias("deleted"), inserted.alias("inserted")
    )
    edits = F.array(
        one(at(1), 40, F.lit("")), one(at(2), 0, F.substring("text", 1, 60)), one(at(3), 1, F.lit("."))
    ).cast(EDITS)
    return docs.select("doc_id", "text", edits.alias("edits"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    trees = stored(build_trees(docs, vocabulary, pattern), "token-trees")
    return apply_edits(derived_edits(docs), trees, vocabulary, pattern)
