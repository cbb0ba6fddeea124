"""Token counts that follow edits.

Each document keeps its text and a segment tree over leaves of some pieces (see ``bpe``: a piece begins a new word whatever
stands before it). The tree's nodes hold characters and tokens. An edit finds its leaves by descending on characters, takes
in the neighbour where the edit has made a border unsafe, encodes that region alone, and updates the sums on the way up.
Trees are built once, stored, and read again for every later round of edits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import FOLDER, VOCABULARY, Encoder, encoder, share
from tessera.llm.common import batches, out, text_bytes

#: Pieces of a leaf.
LEAF = 32
TREE = "doc_id bigint, text string, chars array<bigint>, tokens array<bigint>"
EDIT = "struct<start: bigint, length: bigint, insert: string>"


def leaves(e: Encoder, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Characters and tokens of the leaves of each text."""
    raw, offsets = text_bytes(texts, fold=False)
    if not len(raw):
        return [(np.zeros(1, np.int64), np.zeros(1, np.int64))] * len(texts)
    begins, _, count = e.pieces(raw, offsets)
    first = np.searchsorted(begins, offsets)
    char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    result = []
    for a, b, end in zip(first[:-1].tolist(), first[1:].tolist(), offsets[1:].tolist()):
        if a == b:
            result.append((np.zeros(1, np.int64), np.zeros(1, np.int64)))
            continue
        at = np.append(begins[a:b:LEAF], end)
        result.append((np.diff(char[at]), np.add.reduceat(count[a:b], np.arange(0, b - a, LEAF))))
    return result


def tree(values: np.ndarray) -> list[int]:
    """Sums of a binary tree in heap order; its leaves are the values, filled up with zeros to a power of two."""
    size = 1 << max(0, (len(values) - 1).bit_length())
    level = np.zeros(size, np.int64)
    level[: len(values)] = values
    levels = [level]
    while len(level) > 1:
        level = level.reshape(-1, 2).sum(1)
        levels.append(level)
    return np.concatenate([[0], *reversed(levels)]).tolist()


def find(sums: list[int], at: int) -> tuple[int, int]:
    """The leaf that holds a character (the last one for the end of the text), and where that leaf begins."""
    node, begin, size = 1, 0, len(sums) // 2
    while node < size:
        node *= 2
        if at >= begin + sums[node] and sums[node + 1]:
            begin += sums[node]
            node += 1
    return node - size, begin


def put(sums: list[int], leaf: int, value: int) -> None:
    node = leaf + len(sums) // 2
    change = value - sums[node]
    while node:
        sums[node] += change
        node //= 2


def safe(text: str, at: int) -> bool:
    """Whether a word begins at a place whatever is around: a space after something that isn't white space."""
    return at <= 0 or at >= len(text) or (text[at] == " " and not text[at - 1].isspace())


class Document:
    """A text with its trees; ``change`` tells which region has to be encoded, ``settle`` takes its tokens."""

    def __init__(self, text: str, chars: list[int], tokens: list[int]):
        self.text, self.chars, self.tokens, self.encoded = text, list(chars), list(tokens), 0

    def change(self, start: int, length: int, insert: str) -> str:
        start = min(max(0, start), len(self.text))
        end = min(len(self.text), start + max(0, length))
        size = len(self.chars) // 2
        (low, begin), (high, at) = find(self.chars, start), find(self.chars, max(start, end - 1))
        stop = at + self.chars[size + high]
        shift = len(insert) - (end - start)
        self.text = self.text[:start] + insert + self.text[end:]
        while not safe(self.text, begin):
            low -= 1
            begin -= self.chars[size + low]
        while not safe(self.text, stop + shift):
            high += 1
            stop += self.chars[size + high]
        self.low, self.high, self.region = low, high, self.text[begin : stop + shift]
        return self.region

    def settle(self, tokens: int) -> None:
        """The region becomes one leaf; leaves that it took in stay, empty."""
        self.encoded += len(self.region)
        for leaf in range(self.low, self.high + 1):
            own = leaf == self.low
            put(self.chars, leaf, len(self.region) if own else 0)
            put(self.tokens, leaf, tokens if own else 0)


def trees(df: DataFrame, path: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """(doc_id, text, chars, tokens) with the trees' sums in heap order; the root is entry 1. Null and empty texts have one empty leaf."""
    shared = share(df, path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])

    def run(parts):
        e = encoder(shared, path)
        for b in batches(parts):
            found = leaves(e, b.column(1))
            yield out(schema, b.column(0), b.column(1).fill_null(""), [tree(c) for c, _ in found], [tree(t) for _, t in found])

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TREE)


def edit(df: DataFrame, path: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """Apply the column ``edits`` (an array of start, length, insert, in order, each on the text that the one before left) to trees.

    Returns doc_id, text, chars, tokens after the edits, n_before and n_tokens, and n_encoded, the characters that were encoded
    again. Places outside a text are moved to its ends; null edits, null starts and null array entries change nothing; a null
    insert is empty. Every row is by itself, repeated ones too.
    """
    shared = share(df, path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64())), ("n_before", pa.int64()), ("n_tokens", pa.int64()), ("n_encoded", pa.int64())])

    def run(parts):
        e = encoder(shared, path)
        for b in batches(parts):
            docs = [Document(t or "", c, k) for t, c, k in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            before = [d.tokens[1] for d in docs]
            todo = [[x for x in edits or () if x and x["start"] is not None] for edits in b.column(4).to_pylist()]
            for turn in range(max(map(len, todo))):
                open_ = [(d, x[turn]) for d, x in zip(docs, todo) if turn < len(x)]
                regions = [d.change(x["start"], x["length"] or 0, x["insert"] or "") for d, x in open_]
                _, at = e.encode(pa.array(regions, pa.string()))
                for (d, _), n in zip(open_, np.diff(at).tolist()):
                    d.settle(n)
            yield out(schema, b.column(0), [d.text for d in docs], [d.chars for d in docs], [d.tokens for d in docs], before, [d.tokens[1] for d in docs], [d.encoded for d in docs])

    source = df.select("doc_id", "text", "chars", "tokens", F.col("edits").cast(f"array<{EDIT}>").alias("edits"))
    return source.mapInArrow(run, f"{TREE}, n_before bigint, n_tokens bigint, n_encoded bigint")


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """Trees with their edits from rows (doc_id, turn, start, length, insert) as the column ``edits``, in order of turn."""
    own = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("turn", "start", "length", "insert"))).alias("edits"))
    return state.join(own.withColumn("edits", F.transform("edits", lambda x: x.dropFields("turn"))), "doc_id", "left")
