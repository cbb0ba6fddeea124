"""Packing of documents into sequences of bounded length.

How many pieces there are of each length decides the packing, so it is found on that histogram, which has at most as many
entries as a sequence has tokens, however many documents there are. First Martello and Toth's dominance reduction: while a
small set of lengths with the longest member dominates every other set that has it, sets of that kind are fixed for good.
Best fit, longest first, packs the rest. The plan is a list of runs: the pieces of one length with ranks in a range go to
consecutive sequences. Ranks come from two passes over the pieces (a count per partition and length, then sums over the
partitions), so no task sees all pieces of a length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import FOLDER, VOCABULARY, encoder, share
from tessera.llm.common import batches, out, settle

CAPACITY = 1024
END = 2


def dominant(count: np.ndarray, j: int, capacity: int) -> list[int] | None:
    """The lengths that, with one piece of length j, dominate every other set with such a piece; None if no small set is known to.

    ``count`` is the number of pieces of each length that aren't fixed yet, the piece at hand included.
    """
    rest = capacity - j
    own = count.copy()
    own[j] -= 1
    there = np.flatnonzero(own)
    fits = there[there <= rest]
    if not len(fits):
        return []
    k = int(fits[-1])
    if k == rest:
        return [k]
    least = np.repeat(there[:3], np.minimum(own[there[:3]], 3))[:3]
    if len(least) < 2 or least[0] + least[1] > rest:
        return [k]
    if len(least) == 3 and least.sum() <= rest:
        return None
    # At most two others fit. Pairs (a, b), a >= b: for each a the largest b; a length may count twice, which only adds pairs.
    a = fits[rest - fits >= fits[0]]
    b = fits[np.searchsorted(fits, np.minimum(a, rest - a), side="right") - 1]
    if (a + b).max() <= k:
        return [k]
    second = own.copy()
    second[k] -= 1
    left = np.flatnonzero(second[: rest - k + 1])
    if len(left) and b.max() <= left[-1]:  # the largest piece that fits, and the largest possible second one
        return [k, int(left[-1])]
    return None


def reduce(count: np.ndarray, capacity: int) -> tuple[list[tuple[list[tuple[int, int]], int]], np.ndarray]:
    """Fixed sets as (lengths with how many of each, number of such sets), and what is left to pack."""
    count, fixed, again = count.copy(), [], True
    while again:
        again = False
        for j in np.flatnonzero(count)[::-1].tolist():
            while count[j] and (others := dominant(count, j, capacity)) is not None:
                members = {x: [j, *others].count(x) for x in {j, *others}}
                n = min(int(count[x]) // m for x, m in members.items())
                for x, m in members.items():
                    count[x] -= n * m
                fixed.append((sorted(members.items(), reverse=True), n))
                again = True
    return fixed, count


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Longest first, each piece into the fullest sequence that has room; equal sequences are kept as one group."""
    room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    for x in np.flatnonzero(count)[::-1].tolist():
        n = int(count[x])
        while n:
            space = min((r for r in room if r >= x), default=capacity)
            groups = room.get(space, [((), n)]) if space in room else [((), n)]
            held, have = groups[-1]
            each = min(space // x, n)
            m = min(have, n // each)
            if space in room:
                groups.pop()
                if have > m:
                    groups.append((held, have - m))
                if not groups:
                    del room[space]
            room.setdefault(space - each * x, []).append(((*held, (x, each)), m))
            n -= m * each
    return [(list(held), m) for groups in room.values() for held, m in groups]


def plan(count: np.ndarray, capacity: int) -> np.ndarray:
    """Runs as rows (length, first rank, ranks, pieces a sequence, first sequence, place in the sequence)."""
    fixed, left = reduce(count, capacity)
    rank, sequence, runs = np.zeros(capacity + 1, np.int64), 0, []
    for members, n in [*fixed, *best_fit(left, capacity)]:
        place = 0
        for x, each in members:
            runs.append((x, rank[x], n * each, each, sequence, place))
            rank[x] += n * each
            place += x * each
        sequence += n
    runs = np.array(runs, np.int64).reshape(-1, 6)
    return runs[np.lexsort((runs[:, 1], runs[:, 0]))]


FIELDS = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(df: DataFrame, path: str, capacity: int, end: int, ids: bool) -> DataFrame:
    """Pieces of every document, numbered within their partition and length."""
    shared = share(df, path)
    more = [("ids", pa.binary())] if ids else []
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((x, pa.int64()) for x in ("start", "length", "ids_crc32")), *more, ("part", pa.int32()), ("place", pa.int64())])

    def run(parts):
        e, part, seen = encoder(shared, path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        tail = int(end).to_bytes(4, "little")
        for b in batches(parts):
            tokens, at = e.encode(b.column(1))
            raw, at = tokens.astype("<u4").tobytes(), at.tolist()
            rows = []
            for doc, i, j in zip(b.column(0).to_pylist(), at, at[1:]):
                own, n = raw[4 * i : 4 * j] + tail, j - i + 1
                first = n % capacity or capacity
                for piece, stop in enumerate(range(first, n + 1, capacity)):
                    start = max(0, stop - capacity) if piece else 0
                    x = own[4 * start : 4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(x), *([x] if ids else []), part, seen[stop - start]))
                    seen[stop - start] += 1
            yield out(schema, *zip(*rows))

    return df.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, FIELDS + ids * ", ids binary" + ", part int, place bigint")


def pack(df: DataFrame, path: str = f"{FOLDER}/{VOCABULARY}", capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """Pack the tokens of every ``text``, each with ``end`` behind, into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, piece (from 0), start (tokens of the document before it), length, ids_crc32 (of its ids
    as little-endian unsigned 32-bit integers), sequence_id, offset (its place there, gapless from 0), and its ids if asked
    for. Only documents longer than a sequence are cut; their first piece takes what is over. Null and empty texts are the
    end token alone. Repeated rows are packed each for itself; a null doc_id stays null; ties between equal lengths are
    resolved by partition and place; no rows give no rows. Other columns are not looked at.
    """
    spark = df.sparkSession
    pieces = settle(cut(df, path, capacity, end, ids), "pieces")
    counts = settle(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    count = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        count[r["length"]] = r["n"]
    runs = spark.sparkContext.broadcast(plan(count, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["part", "length"])
    names = [c for c in pieces.columns if c not in ("part", "place")]
    schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(parts):
        table = runs.value
        key = table[:, 0] << 48 | table[:, 1]
        for b in batches(parts):
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            run = table[np.searchsorted(key, length << 48 | rank, side="right") - 1]
            sequence, slot = np.divmod(rank - run[:, 1], run[:, 3])
            columns = [b.column(b.schema.get_field_index(c)) for c in names]
            more = [pa.array(sequence + run[:, 4]), pa.array(run[:, 5] + slot * length)]
            yield pa.RecordBatch.from_arrays(columns + more, names=names + schema.names)

    fields = FIELDS + ids * ", ids binary" + ", sequence_id bigint, offset bigint"
    return ranked.select(*names, (F.col("first") + F.col("place")).alias("rank")).mapInArrow(place, fields)
