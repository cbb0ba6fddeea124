"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

Every text's set of word shingles gets a signature of K coordinates. A set is posted under its (coordinate, value) pairs, and
two sets collide where they share one. Sets whose similarity reaches the limit share at least T of K pairs but for one in a
few million, so T collisions are what a candidate needs; candidates are then confirmed on the full sets.

Prefix: a set is posted only under the K - T + 1 of its pairs that are rarest over all documents; of T common pairs one is
then in both prefixes. Pairs that one document alone has are not posted at all, which leaves few postings, and a passage that
a third of all documents share is never among the rarest of a text that differs otherwise.

Skip: equal sets are one node before all else. Every node is first confirmed against one pivot, the node it collides with most
among the smallest nodes of its posting lists. Lists that then lie in one component hold nothing new and are skipped, and in
the other lists so are pairs of one component, and pairs that a list further ahead counts. Long lists are merged in pairs of
blocks of bounded size, so a group of n near copies costs about n confirmations and no task holds it whole. Every pair left is
counted and, with T collisions, confirmed: no candidate is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, forget, out, settle, small_batches
from tessera.llm.components import components
from tessera.llm.shingles import MinHash, shingle_sets

K = 64
#: Most nodes of a block of a posting list.
BLOCK = 512
#: Largest probability that a pair exactly at the similarity limit has too few collisions.
MISS = 1e-6


def collisions(similarity: float, k: int = K, miss: float = MISS) -> int:
    """The largest number of common coordinates that a pair at the limit reaches but for a share ``miss``."""
    below, t = 0.0, 0
    while (below := below + comb(k, t) * similarity**t * (1 - similarity) ** (k - t)) <= miss:
        t += 1
    return max(1, t)


def signatures(df: DataFrame, size: int) -> DataFrame:
    """A row number, the set's size, digest and signature, and the columns after the first, which is ``text``.

    Row numbers hold once the frame has been written down.
    """
    schema = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("tokens", pa.list_(pa.int64()))])
    names = [*schema.names, *df.columns[1:]]

    def run(parts):
        hasher, row = MinHash(K), TaskContext.get().partitionId() << 40
        for b in batches(parts):
            sets = shingle_sets(b.column(0), size)
            marks = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist() for s in sets]
            tokens = [hasher.tokens(s) if len(s) else None for s in sets]
            rows = np.arange(row, row + b.num_rows)
            row += b.num_rows
            own = out(schema, rows, [len(x) for x in sets], [m[0] for m in marks], [m[1] for m in marks], tokens)
            yield pa.RecordBatch.from_arrays([*own.columns, *b.columns[1:]], names=names)

    fields = "".join(f", `{x.name}` {x.dataType.simpleString()}" for x in df.schema[1:])
    small_batches(df.sparkSession)
    return df.mapInArrow(run, f"row bigint, n bigint, d1 bigint, d2 bigint, tokens array<bigint>{fields}")


#: Bits of the filter that texts pass before they are shuffled: its size is fixed, whatever the number of texts.
BITS = 1 << 25


def texts_of(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``wanted`` (node, t1, t2), from rows (text, t1, t2). Most other texts are left out before the shuffle."""
    place = F.pmod("t1", F.lit(BITS))
    words = wanted.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(t1, {BITS}) & 63 as int))")).alias("bits")).toPandas()
    mask = np.zeros(BITS >> 6, np.int64)
    mask[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = source.sparkSession.sparkContext.broadcast(mask.view(np.uint64))

    def run(parts):
        mask = shared.value
        for b in batches(parts):
            at = np.mod(b.column(1).to_numpy(), BITS)
            hit = (mask[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield b.filter(pa.array(hit == 1))

    near = source.select("text", "t1", "t2").mapInArrow(run, "text string, t1 bigint, t2 bigint")
    return near.join(wanted, ["t1", "t2"]).groupBy("node").agg(F.first("text").alias("text"))


def whole_groups(parts: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups, and where the groups begin and end, from batches that are sorted by integer keys."""
    held: list[pa.RecordBatch] = []

    def ready(tables):
        t = pa.Table.from_batches(tables).combine_chunks()
        keys = [t.column(c).to_numpy() for c in key]
        change = np.zeros(len(t), bool)
        for x in keys:
            change[1:] |= x[1:] != x[:-1]
        return t, [0, *np.flatnonzero(change).tolist(), len(t)]

    for b in batches(parts):
        held.append(b)
        t, cut = ready(held)
        if len(cut) > 2:
            yield t.slice(0, cut[-2]), cut[:-1]
            held = t.slice(cut[-2]).to_batches()
    if held:
        yield ready(held)


def dealt(df: DataFrame, key: list[str], run: Callable, schema: str) -> DataFrame:
    """Hand each worker the rows of its groups, sorted by the group's key."""
    return df.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


GROUP = ["list", "i", "j"]


def blocks(df: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows of each list in every pair of blocks that their own block is in; ``lists`` has the lists' sizes."""
    many = F.expr(f"cast(ceil(size / {BLOCK}) as int)")
    own = df.join(lists.withColumn("blocks", many), "list").withColumn("own", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    pairs = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return pairs.withColumn("i", F.least("own", "other").cast("bigint")).withColumn("j", F.greatest("own", "other").cast("bigint")).drop("blocks", "other", "size")


def confirm(groups: DataFrame, texts: DataFrame, size: int, limit: float) -> DataFrame:
    """Links (a, b) among the pairs of rows (list, i, j, node, partners): each node with its partners in the group.

    The similarity is taken on full sets. Pairs that are joined already by links found in the group are passed over.
    """
    p, q = round(limit * 1000), 1000
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(parts):
        for t, cut in whole_groups(parts, GROUP):
            node, partners = t.column("node").to_numpy(), t.column("partners").to_pylist()
            text = t.column("text").combine_chunks() if isinstance(t.column("text"), pa.ChunkedArray) else t.column("text")
            text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
            links = []
            for a, b in zip(cut, cut[1:]):
                sets = dict(zip(node[a:b].tolist(), shingle_sets(text.slice(a, b - a), size)))
                root = {x: x for x in sets}

                def top(x):
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for x, ys in zip(node[a:b].tolist(), partners[a:b]):
                    for y in ys or ():
                        if top(x) == top(y):
                            continue
                        m, n = len(sets[x]), len(sets[y])
                        if min(m, n) * q < p * max(m, n):
                            continue
                        common = m + n - len(np.union1d(sets[x], sets[y]))
                        if q * common >= p * (m + n - common):
                            root[top(x)] = top(y)
                            links.append((x, y))
            if links:
                yield out(schema, *zip(*links))

    found = groups.join(texts, "node").select(*GROUP, "node", "partners", "text")
    return dealt(found, GROUP, run, "a bigint, b bigint")


def counted(postings: DataFrame, threshold: int) -> DataFrame:
    """Rows (list, i, j, node, partners) of pairs of different components that collide often enough, each pair at its first common list."""
    schema = pa.schema([(x, pa.int64()) for x in GROUP] + [("node", pa.int64()), ("partners", pa.list_(pa.int64()))])

    def run(parts):
        for t, cut in whole_groups(parts, GROUP):
            keys = [t.column(c).to_numpy() for c in (*GROUP, "node", "component", "own")]
            tokens, prefix = (t.column(c).to_pylist() for c in ("tokens", "prefix"))
            rows = []
            for a, b in zip(cut, cut[1:]):
                node, component = keys[3][a:b], keys[4][a:b]
                if component.min() == component.max():
                    continue
                here, i, j = (int(x[a]) for x in keys[:3])
                n, hits = b - a, {}
                for kind, values in (("ahead", prefix[a:b]), ("all", tokens[a:b])):
                    flat = np.concatenate([np.asarray(v, np.int64) for v in values])
                    owner = np.repeat(np.arange(n), [len(v) for v in values])
                    if kind == "ahead":
                        flat, owner = flat[flat < here], owner[flat < here]
                    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
                    shared = np.cumsum(often > 1) - 1
                    keep = often[column] > 1
                    owner, column = owner[keep], shared[column[keep]]
                    hits[kind] = np.zeros((n, n), np.float32)
                    for first in range(0, int(shared[-1]) + 1 if len(shared) else 0, 4096):  # bounds the memory of long lists
                        part = (column >= first) & (column < first + 4096)
                        m = np.zeros((n, 4096), np.float32)
                        m[owner[part], column[part] - first] = 1
                        hits[kind] += m @ m.T
                good = (hits["ahead"] == 0) & (hits["all"] >= threshold) & (component[:, None] != component[None, :])
                good &= node[:, None] > node[None, :]
                if i != j:
                    half = keys[5][a:b]
                    good &= half[:, None] != half[None, :]
                seen = np.flatnonzero(good.any(0) | good.any(1))
                rows += [(here, i, j, int(node[x]), node[good[x]].tolist()) for x in seen]
            if rows:
                yield out(schema, *zip(*rows))

    return dealt(postings, GROUP, run, "list bigint, i bigint, j bigint, node bigint, partners array<bigint>")


def marked(df: DataFrame, *more) -> DataFrame:
    """text and doc_id by type, two hashes of the text, and further columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return df.select(text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), F.col("doc_id").cast("bigint").alias("doc_id"), *more)


def near_duplicates(df: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """Groups of texts that are linked, directly or by others, by a Jaccard similarity of their sets of ``size``-word shingles.

    Words are what stands between spaces and the controls from tab to carriage return, A-Z lower-cased. A text with fewer words
    is one shingle; null texts and texts without words have none and are linked with nothing. Returns a row per row, repeated
    ones too: doc_id, n_shingles, component_id (the smallest doc_id that can be reached, null only if all are null), kept
    (doc_id is component_id), first (true for one row of each group, also if ids repeat), and two hashes of the text. No rows
    give no rows; other columns are not looked at.
    """
    source = marked(df).select("text", "t1", "t2", "doc_id")
    rows = settle(signatures(source, size), "signatures")
    threshold = collisions(similarity)
    classes = settle(rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("node")), "classes")
    own = settle(rows.select("row", "t1", "t2", "tokens").join(classes.select(F.col("node").alias("row")), "row", "left_semi"), "nodes")
    posted = own.select(F.col("row").alias("node"), F.explode("tokens").alias("list"))
    often = posted.groupBy("list").agg(F.count("*").alias("often")).filter("often > 1")
    shared = posted.join(often, "list").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "list"))).alias("s"))
    nodes = shared.filter(F.size("s") >= threshold).select("node", F.col("s.list").alias("tokens"))
    nodes = settle(nodes.withColumn("prefix", F.expr(f"slice(tokens, 1, size(tokens) - {threshold} + 1)")), "candidates")
    wanted = own.select(F.col("row").alias("node"), "t1", "t2").join(nodes.select("node"), "node", "left_semi")
    wanted = settle(wanted, "wanted")
    texts = settle(texts_of(source, wanted), "texts")
    forget(own, wanted)

    postings = nodes.select("node", F.explode("prefix").alias("list"))
    lists = postings.groupBy("list").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).filter("size > 1")
    tried = postings.join(lists, "list").filter("node > pivot").groupBy("node", "pivot").agg(F.count("*").alias("n"))
    stars = settle(tried.groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot")), "pivots")
    sizes = stars.groupBy("pivot").agg(F.count("*").alias("size"))
    salted = stars.join(sizes, "pivot").withColumn("i", F.expr(f"pmod(xxhash64(node), cast(ceil(size / {BLOCK}) as bigint))"))
    salted = salted.select(F.col("pivot").alias("list"), "i", F.lit(0).cast("bigint").alias("j"), "node", F.array("pivot").alias("partners"))
    centres = salted.select(*GROUP, F.col("list").alias("node"), F.array().cast("array<bigint>").alias("partners")).distinct()
    near = settle(confirm(salted.unionByName(centres), texts, size, similarity), "near")

    joined = components(near)
    placed = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    posted = settle(placed.withColumn("list", F.explode("prefix")), "postings")
    lists = posted.groupBy("list").agg(F.count("*").alias("size"), F.min("component").alias("a"), F.max("component").alias("b"))
    left = counted(blocks(posted, lists.filter("a < b").select("list", "size")), threshold)
    more = settle(confirm(left, texts, size, similarity), "more")
    joined = components(near.unionByName(more)).withColumnRenamed("component", "root")

    member = rows.select("row", "doc_id", "n", "d1", "d2", "t1", "t2").join(classes, ["d1", "d2"], "left").join(joined, "node", "left")
    member = settle(member.select("row", "doc_id", "n", "t1", "t2", F.coalesce("root", "node", "row").alias("root")), "members")
    forget(rows, classes, nodes, stars, texts, near, posted, more)
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")
    firsts = member.groupBy("root").agg(F.min(order).alias("least")).select("root", "least.doc_id", "least.row")
    firsts = firsts.toDF("root", "component_id", "first_row")
    told = member.join(firsts, "root")
    own = F.col("row") == F.col("first_row")
    return told.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), own.alias("first"), "t1", "t2")


def without_duplicates(df: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of the frame, all its columns as they are, but one row of each group of near duplicates: that of the smallest doc_id."""
    key = ["none", "id", "t1", "t2"]  # without nulls, so that one shuffle serves the join and what follows

    def keyed(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "t1", "t2", *more)

    first = keyed(near_duplicates(df, size, similarity).filter("first"))
    docs = keyed(marked(df, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")), "doc")
    return docs.join(first, key, "left_semi").dropDuplicates(key).select("doc.*")
