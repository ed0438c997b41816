"""Edit-aware token counts: a segment tree over pre-token stretches per document.

A text is cut into leaves of about ``LEAF`` characters at blanks between two
characters that are no white space; such a blank always starts a pre-token, so
a text's token count is the sum over its leaves.  Each document keeps a segment
tree of (characters, tokens) over its leaves, in heap order: node ``i`` sums
nodes ``2i`` and ``2i + 1``, node 1 is the document.

An edit replaces characters ``[start, stop)``.  The leaves it touches are found
by descending the tree by character sums; those leaves and the next leaf with
text on either side (the boundary context, so that the outer cuts stay between untouched
characters) are re-encoded, dealt over the same leaf slots, and only the sums on
the paths to the root change.  A document whose leaf has outgrown ``8 * LEAF``
is rebuilt.

Everything is map-only over Arrow batches; a document's edits are an array
column on its row, applied in order, each to the text the previous one left.

Defined results: null text is an empty text with one empty leaf; positions are
code points and are clipped to the text; an edit with null bounds is skipped,
a null replacement is empty; null or empty edits change nothing; extra columns
are kept, repeated rows are separate documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import read_ranks
from ledgerline.llm.workers import ship

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LEAF = 256
EDITS = "array<struct<start:bigint,stop:bigint,text:string>>"

_cut = re.compile(r"(?<=\S)(?= \S)").split


def leaves(text: str) -> list[str]:
    """Consecutive parts of a text, each of about ``LEAF`` characters or one longer stretch."""
    out, held, size = [], [], 0
    for part in _cut(text) if text else [""]:
        held.append(part)
        size += len(part)
        if size >= LEAF:
            out.append("".join(held))
            held, size = [], 0
    if held or not out:
        out.append("".join(held))
    return out


class Tree:
    """Segment tree of one document over ``size`` leaf slots (a power of two)."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def build(cls, parts: list[str], count) -> Tree:
        size = 1
        while size < len(parts):
            size *= 2
        pad = [0] * (size - len(parts))
        tree = cls([0] * size + [len(p) for p in parts] + pad, [0] * size + count(parts) + pad)
        for i in range(size - 1, 0, -1):
            tree._sum(i)
        return tree

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(leaf slot, its first character) of the leaf that holds a position."""
        i, first = 1, 0
        while i < self.size:
            i *= 2
            if position >= first + self.chars[i] and self.chars[i + 1]:
                first += self.chars[i]
                i += 1
        return i - self.size, first

    def start_of(self, slot: int) -> int:
        """First character of a leaf slot."""
        i, first = slot + self.size, 0
        while i > 1:
            if i % 2:
                first += self.chars[i - 1]
            i //= 2
        return first

    def context(self, slot: int, step: int) -> int:
        """The next slot in a direction that holds text, else the one next to ``slot``."""
        at = slot + step
        while 0 <= at < self.size and not self.chars[at + self.size]:
            at += step
        return at if 0 <= at < self.size else min(max(0, slot + step), self.size - 1)

    def put(self, slot: int, parts: list[str], count) -> None:
        """Replace consecutive leaves and update the sums above them."""
        for k, tokens in enumerate(count(parts)):
            i = slot + k + self.size
            self.chars[i], self.tokens[i] = len(parts[k]), tokens
        lo, hi = (slot + self.size) // 2, (slot + len(parts) - 1 + self.size) // 2
        while lo:
            for i in range(lo, hi + 1):
                self._sum(i)
            lo, hi = lo // 2, hi // 2


def _deal(text: str, n: int) -> list[str]:
    """Cut a region into exactly ``n`` leaves, as evenly as its stretches allow."""
    parts = _cut(text) if text else [""]
    out, at = [], 0
    for k in range(n):
        stop = len(parts) * (k + 1) // n
        out.append("".join(parts[at:stop]))
        at = stop
    return out


def edited(text: str, tree: Tree, start: int, stop: int, new: str, count) -> tuple[str, Tree, int]:
    """(text, tree, characters re-encoded) after one edit."""
    start = min(max(0, start), len(text))
    stop = min(max(start, stop), len(text))
    low, _ = tree.leaf_at(start)
    high, _ = tree.leaf_at(max(start, stop - 1))
    low, high = tree.context(low, -1), tree.context(high, 1)
    first = tree.start_of(low)
    after = tree.start_of(high) + tree.chars[high + tree.size]
    region = text[first:start] + new + text[stop:after]
    text = text[:start] + new + text[stop:]
    parts = _deal(region, high - low + 1)
    if max(map(len, parts)) > 8 * LEAF and len(region) > 8 * LEAF * len(parts) // 2:
        return text, Tree.build(leaves(text), count), len(text)
    tree.put(low, parts, count)
    return text, tree, len(region)


def _counter(ranks: dict[bytes, int]):
    encoding = tiktoken.Encoding(
        "counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encode = encoding.encode_ordinary
    return lambda parts: [len(encode(p)) for p in parts]


TREE = "struct<chars:array<bigint>,tokens:array<bigint>>"
_tree_type = pa.struct([("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])


def build(docs: DataFrame, path: str = RANKS, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and tree."""
    return _apply(docs, None, path, text)


def edit(docs: DataFrame, edits: Column, path: str = RANKS, text: str = "text") -> DataFrame:
    """``docs`` (with ``tree``) after each row's edits: text, n_tokens, tree, n_reencoded (characters)."""
    return _apply(docs.withColumn("__edits", edits.cast(EDITS)), "__edits", path, text)


def _apply(docs: DataFrame, edits: str | None, path: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_ranks(path))
    given = docs.columns
    replaced = {text, "n_tokens", "tree", "n_reencoded", "__edits"}
    kept = [c for c in given if c not in replaced]
    names = [*kept, text, "n_tokens", "tree"] + ["n_reencoded"] * (edits is not None)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield one(part, count)

    def one(part: pa.RecordBatch, count) -> pa.RecordBatch:
        texts = [t or "" for t in part.column(given.index(text)).to_pylist()]
        trees, redone = [], []
        if edits is None:
            for t in texts:
                tree = Tree.build(leaves(t), count)
                trees.append({"chars": tree.chars, "tokens": tree.tokens})
        else:
            held = part.column(given.index("tree")).to_pylist()
            todo = part.column(given.index(edits)).to_pylist()
            for i, t in enumerate(texts):
                tree = Tree(held[i]["chars"], held[i]["tokens"])
                total = 0
                for e in todo[i] or []:
                    if e is None or e["start"] is None or e["stop"] is None:
                        continue
                    t, tree, n = edited(t, tree, e["start"], e["stop"], e["text"] or "", count)
                    total += n
                texts[i] = t
                redone.append(total)
                trees.append({"chars": tree.chars, "tokens": tree.tokens})
        arrays = [part.column(given.index(c)) for c in kept]
        arrays += [pa.array(texts, pa.string()), pa.array([t["tokens"][1] for t in trees], pa.int64())]
        arrays.append(pa.array(trees, _tree_type))
        if edits is not None:
            arrays.append(pa.array(redone, pa.int64()))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    fields = ", ".join(
        [f"`{text}` string", "n_tokens bigint", f"tree {TREE}"] + ["n_reencoded bigint"] * (edits is not None)
    )
    schema = docs.select(*kept).schema
    for field in spark.createDataFrame([], fields).schema.fields:
        schema = schema.add(field)
    return docs.mapInArrow(run_batches, schema)
