"""Byte-pair encoding by a compiled tokenization automaton.

A merge list defines which symbol sequences are right tokenizations. The automaton that accepts exactly those has the last
symbol as its state. It is built one merge at a time: the gadget of the merge ``a b -> c`` adds the arc label and state
``c``, lets ``c`` follow whatever ``a`` could follow, lets after ``c`` come whatever could come after ``b``, and removes
the arc ``b`` from state ``a``. States with equal arcs and arcs with equal sources are then joined, which leaves a bit
table of a few MB.

A word is encoded by reading it left to right: for each end, the one symbol whose arc leaves the state of the prefix before
it. ``Encoder`` does that for all new words of a batch at once. Words are split off by the vocabulary's pattern before;
what is known already comes from a bounded cache. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import batches, digests, out, small_batches, text_bytes

#: Where the public vocabulary files lie.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.json"
#: Fixed: the word pattern of byte-level vocabularies, with white space as Unicode defines it.
SPACE = r"\t-\r \x85\xa0  -     　"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable in Latin-1, else from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def numbered(rows, kinds: dict[bytes, int]) -> list[int]:
    """A number for each row of bytes, equal for equal rows."""
    return [kinds.setdefault(hashlib.blake2b(row, digest_size=16).digest(), len(kinds)) for row in rows]


def compile_merges(n: int, merges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Automaton of a merge list over symbols 0..n-1; merges has rows (a, b, c) in order of priority.

    Returns the class of each symbol as a state, its class as an arc label, and the bit table of the removed arcs. Symbols
    share a column of removed arcs until a merge tells them apart, which keeps the memory at a third of one column each.
    """
    removed = np.zeros(((n + 7) // 8, 1 << 12), np.uint8)  # bit y of column x: arc y is removed from the states of class x
    own, size = np.zeros(n, np.int64), [n - len(merges)]
    for a, b, c in merges.tolist():
        removed[c >> 3, : len(size)] |= ((removed[a >> 3, : len(size)] >> (a & 7)) & 1) << (c & 7)
        own[c] = own[b]
        size[own[b]] += 1
        if size[own[a]] > 1:
            if len(size) == removed.shape[1]:
                removed = np.concatenate([removed, np.zeros((len(removed), 1 << 12), np.uint8)], 1)
            removed[:, len(size)] = removed[:, own[a]]
            size[own[a]] -= 1
            own[a] = len(size)
            size.append(1)
        removed[b >> 3, own[a]] |= 1 << (b & 7)
        if a == b:  # of three equal symbols the first two join
            removed[c >> 3, own[a]] |= 1 << (c & 7)
    kinds: dict[bytes, int] = {}
    same = np.array([k for i in range(0, len(size), 512) for k in numbered(np.ascontiguousarray(removed[:, i : min(i + 512, len(size))].T), kinds)])
    _, first = np.unique(same, return_index=True)
    removed = removed[:, first]
    kinds, arcs, kept = {}, [], []
    for i in range(0, len(removed), 64):
        rows = np.packbits(np.unpackbits(removed[i : i + 64], axis=0, count=min(512, n - 8 * i), bitorder="little"), axis=1, bitorder="little")
        for row, k in zip(rows, numbered(rows, kinds)):
            if k == len(kept):
                kept.append(row.copy())
            arcs.append(k)
    return same[own].astype(np.int32), np.array(arcs, np.int32), np.array(kept)


def spread(x: np.ndarray, size: int) -> np.ndarray:
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (size - 1)


class Tables:
    """What a worker needs: the automaton, the symbols' bytes as a trie, and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, symbols = spec["model"]["vocab"], byte_symbols()
        n = max(vocabulary.values()) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        triples = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges], np.int64)
        self.labels = [b""] * n
        for token, i in vocabulary.items():
            self.labels[i] = bytes(symbols[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.labels += [b""] * (max([n - 1, *self.added.values()]) + 1 - n)
        for token, i in self.added.items():
            self.labels[i] = token.encode()
        self.states, self.arcs, self.removed = compile_merges(n, triples)
        self._trie({self.labels[i]: i for i in vocabulary.values()})

    def _trie(self, tokens: dict[bytes, int]) -> None:
        """Children by (node, byte) in an open hash table; symbol[node] is the symbol that ends there, or -1."""
        nodes, symbol = {b"": 0}, [-1]
        edges = []
        for token in tokens:
            at = 0
            for k in range(1, len(token) + 1):
                below = nodes.get(token[:k])
                if below is None:
                    below = nodes[token[:k]] = len(symbol)
                    symbol.append(-1)
                    edges.append((at << 8 | token[k - 1], below))
                at = below
            symbol[at] = tokens[token]
        self.symbol = np.array(symbol, np.int32)
        size = 1 << (8 * len(edges)).bit_length()
        self.keys, self.below = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        for (key, child), at in zip(edges, spread(np.array([k for k, _ in edges], np.int64), size).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) & (size - 1)
            self.keys[at], self.below[at] = key, child

    def children(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node below each node by a byte, or -1."""
        key, size = nodes.astype(np.int64) << 8 | byte, len(self.keys)
        at = spread(key, size)
        found = self.keys[at]
        result = np.where(found == key, self.below[at], -1)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (size - 1)
            found = self.keys[at[open_]]
            hit = found == key[open_]
            result[open_[hit]] = self.below[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return result

    def allowed(self, before: np.ndarray, arc: np.ndarray) -> np.ndarray:
        """Whether the automaton has the arc in the state; state -1 is the start, which has all."""
        state = self.states[before]
        return (before < 0) | ((self.removed[self.arcs[arc], state >> 3] >> (state & 7).astype(np.uint8)) & 1 == 0)

    def walk(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of the words (none empty) one after another, and their number in each word, by table-driven transitions."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length) + np.arange(1, len(words) + 1) - 1  # a word of n bytes has n + 1 places
        starts = ends - length
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        inside = np.ones(len(raw), bool)
        inside[ends] = False
        place = np.flatnonzero(inside)
        stop = np.repeat(ends, length)
        offset = place - np.repeat(starts, length)
        node, begun, froms, tos, arcs, when, depth = np.zeros(len(place), np.int32), np.arange(len(place)), [], [], [], [], 0
        while len(begun):
            node = self.children(node, raw[place[begun] + depth])
            alive = node >= 0
            begun, node, depth = begun[alive], node[alive], depth + 1
            hit = self.symbol[node] >= 0
            at = begun[hit]
            froms.append(place[at])
            tos.append(place[at] + depth)
            arcs.append(self.symbol[node[hit]])
            when.append(offset[at] + depth)
            more = place[begun] + depth < stop[begun]
            begun, node = begun[more], node[more]
        froms, tos, arcs, when = map(np.concatenate, (froms, tos, arcs, when))
        order = np.argsort(when, kind="stable")
        froms, tos, arcs = froms[order], tos[order], arcs[order]
        cuts = np.cumsum(np.bincount(when))
        last, back = np.full(len(raw), -1, np.int32), np.zeros(len(raw), np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            right = np.flatnonzero(self.allowed(last[froms[a:b]], arcs[a:b])) + a
            last[tos[right]] = arcs[right]
            back[tos[right]] = froms[right]
        at, open_, chain, owner = ends.copy(), np.arange(len(words)), [], []
        while len(open_):
            chain.append(last[at[open_]])
            owner.append(open_)
            at[open_] = back[at[open_]]
            open_ = open_[at[open_] > starts[open_]]
        chain, owner = np.concatenate(chain[::-1]), np.concatenate(owner[::-1])
        return chain[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@lru_cache(maxsize=2)
def tables(path: str) -> Tables:
    return Tables(path)


class Encoder:
    """Encodes whole texts in one worker.

    Texts are cut before spaces that follow no white space; there the pattern starts a new word whatever else the text holds.
    The pieces' symbols are kept in a hash table of fixed size under 128-bit digests, and begun anew when it is full.
    """

    SLOTS, FILL, LONG = 1 << 21, 1_200_000, 192

    def __init__(self, t: Tables):
        self.t, self.find = t, regex.compile(WORD).findall
        self.added = regex.compile(b"|".join(regex.escape(x.encode()) for x in sorted(t.added, key=len, reverse=True))) if t.added else None
        self.special = {x.encode(): i for x, i in t.added.items()}
        self.label_end = np.cumsum([len(x) for x in t.labels])
        self.label_len = np.array([len(x) for x in t.labels], np.int64)
        self.label_raw = np.frombuffer(b"".join(t.labels), np.uint8)
        self.reset()

    def reset(self) -> None:
        self.key, self.check = np.zeros(self.SLOTS, np.uint64), np.zeros(self.SLOTS, np.uint64)
        self.start, self.count = np.zeros(self.SLOTS, np.int32), np.zeros(self.SLOTS, np.int32)
        self.pool, self.size, self.held = np.zeros(1 << 20, np.uint32), 0, 0

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Add the pieces' symbols to the pool: where they start and how many they are."""
        words, number, special = [], [], {}
        for k, raw in enumerate(pieces):
            if raw in self.special:
                special[k] = self.special[raw]
                words.append(b"a")
                number.append(1)
                continue
            x = raw.decode()
            if x[1:].isalpha() and (x[0] == " " or x[0].isalpha()):
                words.append(raw)
                number.append(1)
            else:
                found = [w.encode() for w in self.find(x)]
                words += found
                number.append(len(found))
        symbols, each = [], []
        for i in range(0, len(words), 50_000):
            a, b = self.t.walk(words[i : i + 50_000])
            symbols.append(a)
            each.append(b)
        symbols, each = np.concatenate(symbols), np.concatenate(each)
        total = np.add.reduceat(each, np.cumsum(number) - number)
        while self.size + len(symbols) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        starts = self.size + np.cumsum(total) - total
        self.pool[self.size : self.size + len(symbols)] = symbols
        self.size += len(symbols)
        for k, i in special.items():
            self.pool[starts[k]], total[k] = i, 1
        return starts, total

    def slots(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each digest is, or where it would go; whether it is there."""
        at = (key >> np.uint64(40)).astype(np.int64) & (self.SLOTS - 1)
        found = (self.key[at] == key) & (self.check[at] == check)
        open_ = np.flatnonzero(~found & (self.key[at] != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (self.SLOTS - 1)
            k = self.key[at[open_]]
            hit = (k == key[open_]) & (self.check[at[open_]] == check[open_])
            found[open_] = hit
            open_ = open_[~hit & (k != 0)]
        return at, found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a text column's rows one after another, and the rows' offsets in them; null texts are empty."""
        raw, offsets = text_bytes(column, fold=False)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        begins, start, count = self.pieces(raw, offsets)
        ends = np.cumsum(count)
        ids = self.pool[np.repeat(start - (ends - count), count) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[np.searchsorted(begins, offsets)]

    def pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the pieces of texts begin, where each one's symbols are in the pool, and how many they are; there is at least one byte."""
        if self.size > 8 * self.FILL:  # long pieces, which aren't kept in the table, use the pool as well
            self.reset()
        data = raw.tobytes()
        begins = self.cuts(raw, data, offsets)
        length = np.diff(np.append(begins, len(raw)))
        key, check = digests(raw, begins, np.minimum(length, self.LONG))
        start, count = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        short = np.flatnonzero(length < self.LONG)
        at, found = self.slots(key[short], check[short])
        start[short], count[short] = self.start[at], self.count[at]
        new = short[~found]
        if len(new):
            if self.held + len(new) > self.FILL:
                self.reset()
                new = short
            _, first, same = np.unique(key[new], return_index=True, return_inverse=True)
            if np.any(check[new] != check[new[first]][same]):  # digests that share a half: one by one
                first, same = np.arange(len(new)), np.arange(len(new))
            one = new[first]
            s, c = self.learn([data[a : a + n] for a, n in zip(begins[one].tolist(), length[one].tolist())])
            start[new], count[new] = s[same], c[same]
            room = self.FILL - self.held  # the rest of a batch of very many pieces serves this batch only
            self.keep(key[one][:room], check[one][:room], s[:room], c[:room])
        long = np.flatnonzero(length >= self.LONG)
        if len(long):
            start[long], count[long] = self.learn([data[a : a + n] for a, n in zip(begins[long].tolist(), length[long].tolist())])
        return begins, start, count

    def keep(self, key, check, start, count) -> None:
        """Put digests into the table; of two that want one slot, the later looks further."""
        left = np.arange(len(key))
        while len(left):
            at, found = self.slots(key[left], check[left])
            left, at = left[~found], at[~found]
            _, first = np.unique(at, return_index=True)
            at, put = at[first], left[first]
            self.key[at], self.check[at], self.start[at], self.count[at] = key[put], check[put], start[put], count[put]
            self.held += len(put)
            rest = np.ones(len(left), bool)
            rest[first] = False
            left = left[rest]

    def cuts(self, raw: np.ndarray, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Places where pieces begin: every text, added tokens, and spaces with no white space before them."""
        space = np.flatnonzero(raw == 32)
        space = space[space > 0]
        before = raw[space - 1]
        free = (before > 32) | (before < 9) | ((before > 13) & (before < 32))
        far = np.flatnonzero(before >= 0x80)  # white space of two or three bytes
        at = space[far]
        b1, b2, b3 = before[far], raw[at - 2], raw[at - 3]
        free[far] = ~(
            ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0)))
            | ((b3 == 0xE1) & (b2 == 0x9A) & (b1 == 0x80))
            | ((b3 == 0xE2) & (b2 == 0x80) & ((b1 <= 0x8A) | (b1 == 0xA8) | (b1 == 0xA9) | (b1 == 0xAF)))
            | ((b3 == 0xE2) & (b2 == 0x81) & (b1 == 0x9F))
            | ((b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80))
        )
        marks = [space[free], offsets[:-1][np.diff(offsets) > 0]]
        if self.added and any(x in data for x in self.special):
            row_ends = set(offsets.tolist())
            for m in self.added.finditer(data):
                if not any(e in row_ends for e in range(m.start() + 1, m.end())):
                    marks.append([m.start(), m.end()])
        begins = np.unique(np.concatenate(marks))
        return begins[begins < len(raw)].astype(np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of rows of ids: the arcs' labels one after another."""
        ids = ids.astype(np.int64)
        n = self.label_len[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return [b""] * (len(offsets) - 1)
        raw = self.label_raw[np.repeat(self.label_end[ids] - ends, n) + np.arange(ends[-1])].tobytes()
        cut = np.concatenate([[0], ends])[offsets].tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(shared, key: str) -> Encoder:
    """The encoder of this worker process; its caches live as long as the worker."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def share(df: DataFrame, path: str):
    """The tables of a vocabulary as a broadcast; their size is fixed by the vocabulary, not by the data."""
    return small_batches(df.sparkSession).sparkContext.broadcast(tables(path))


def encode(df: DataFrame, path: str = f"{FOLDER}/{VOCABULARY}", decoded: bool = False, digest: bool = False) -> DataFrame:
    """Encode the whole ``text`` of each row.

    Returns doc_id, n_tokens, and either ids (binary, little-endian unsigned 32-bit) with the decoded text if asked for, or,
    with ``digest``, ids_sha256 and decoded_sha256 of what ids and decoded would hold. Null and empty texts have no ids;
    repeated rows give repeated rows; a null doc_id stays null; added tokens in a text become their own ids. Other columns
    are not looked at.
    """
    shared = share(df, path)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    fields += [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digest else [("ids", pa.binary()), ("decoded", pa.string())]
    schema = pa.schema(fields)

    def run(parts):
        e = encoder(shared, path)
        for b in batches(parts):
            ids, at = e.encode(b.column(1))
            raw, cut = ids.astype("<u4").tobytes(), (4 * at).tolist()
            parts_of = [raw[i:j] for i, j in zip(cut, cut[1:])]
            texts = e.decode(ids, at) if decoded or digest else []
            if digest:
                texts = [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in texts]
                yield out(schema, b.column(0), np.diff(at), [hashlib.sha256(x).hexdigest() for x in parts_of], texts)
            else:
                yield out(schema, b.column(0), np.diff(at), parts_of, [x.decode("utf-8", "replace") for x in texts] if decoded else [None] * len(parts_of))

    last = "ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string"
    return df.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, f"doc_id bigint, n_tokens bigint, {last}")


def decode(df: DataFrame, path: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """Texts of (doc_id, ids) rows as ``encode`` makes them; null ids are an empty text."""
    shared = share(df, path)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(parts):
        e = encoder(shared, path)
        for b in batches(parts):
            rows = [np.frombuffer(x or b"", "<u4") for x in b.column(1).to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
            yield out(schema, b.column(0), [x.decode("utf-8", "replace") for x in e.decode(np.concatenate(rows), at)])

    return df.selectExpr("cast(doc_id as bigint) doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
