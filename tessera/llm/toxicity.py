"""Toxicity by the nearest labelled examples.

A bounded sample of labelled texts is the example set. Terms are words and word beginnings; those whose share differs between
the two labels beyond chance carry TF-IDF weights, and the cosine is taken over them. The examples lie in an inverted index,
cut into blocks of examples, with the largest weight of every term in each block. A text visits blocks in falling order of the
bound that these give and stops when no further block can hold a nearer example, so its neighbours are exact. Votes weighted by
closeness, set off against the share of toxic texts, are calibrated on the examples themselves, each left out in turn.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, bounded_sample, out, settle, small_batches

#: Labelled rows of each label that become examples, about; all if there are fewer.
PER_LABEL = 3000
NEIGHBOURS = 15
BLOCK = 64
#: Word beginnings that are terms of their own, in letters.
HEADS = (4, 5, 6)
#: Likelihood ratio beyond which a term's shares differ; and the examples that it is in at least.
RATIO, SEEN = 24.0, 3
#: How many times one label's share of a term has to be the other's; leaves out words of a language that is toxic a bit more often.
LIFT = 4.0
#: Similarity that the prior weighs in the vote.
PRIOR = 0.25
REJECT = 0.7

LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(piece: str) -> list[str]:
    """Terms of a stretch of text without white space: its words, and their beginnings with a bar behind."""
    return [t for w in LETTERS.findall(piece) for t in (w, *(w[:n] + "|" for n in HEADS if len(w) >= n))]


@dataclass
class Index:
    """Examples with their TF-IDF vectors as postings by term and block."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray  # how many labelled rows an example stands for
    prior: float
    begin: np.ndarray = field(default=None)  # term x (blocks + 1)
    example: np.ndarray = field(default=None)
    value: np.ndarray = field(default=None)
    largest: np.ndarray = field(default=None)  # term x block
    levels: np.ndarray = field(default=None)
    scores: np.ndarray = field(default=None)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(sorted(counts), np.int64)
        v = (1 + np.log(np.array([counts[x] for x in t.tolist()], float))) * self.idf[t]
        return t, v / max(np.sqrt((v * v).sum()), 1e-12)

    def fill(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        n, blocks = len(vectors), -(-len(vectors) // BLOCK)
        owner = np.repeat(np.arange(n), [len(t) for t, _ in vectors])
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        value = np.concatenate([np.zeros(0), *(v for _, v in vectors)])
        order = np.lexsort((owner, term))
        term, self.example, self.value = term[order], owner[order], value[order]
        cell = term * blocks + self.example // BLOCK
        self.begin = np.searchsorted(cell, np.arange(len(self.terms) * blocks + 1)) if blocks else np.zeros(1, np.int64)
        self.largest = np.zeros((len(self.terms), blocks))
        np.maximum.at(self.largest.reshape(-1), cell, self.value)

    def nearest(self, t: np.ndarray, v: np.ndarray, k: int, but: int = -1) -> list[tuple[float, int]]:
        """The k nearest examples with a positive cosine, nearest first, ties to the earlier example; without example ``but``."""
        blocks = self.largest.shape[1]
        bound = v @ self.largest[t]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(best) == k and bound[b] < -best[-1][0] - 1e-9):
                break
            score = np.zeros(BLOCK)
            for term, weight in zip(t.tolist(), v.tolist()):
                i, j = self.begin[term * blocks + b], self.begin[term * blocks + b + 1]
                score[self.example[i:j] - b * BLOCK] += weight * self.value[i:j]
            if 0 <= but - b * BLOCK < BLOCK:
                score[but - b * BLOCK] = 0
            least = -best[-1][0] if len(best) == k else 0.0
            there = np.flatnonzero((score > 0) & (score >= least))
            best = sorted(best + [(-round(float(score[x]), 12), b * BLOCK + x) for x in there.tolist()])[:k]
        return [(-s, x) for s, x in best]

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic among the neighbours, each by its squared cosine and what it stands for, and the prior."""
        total, toxic = PRIOR, PRIOR * self.prior
        for s, x in near:
            w = s * s * self.weight[x]
            total, toxic = total + w, toxic + w * self.toxic[x]
        return float(toxic / total)

    def calibrate(self, votes: np.ndarray) -> None:
        """Pool adjacent violators: the smallest non-decreasing step function of the votes."""
        pools: list[list[float]] = []
        for i in np.argsort(votes, kind="stable").tolist():
            w = self.weight[i]
            pools.append([votes[i], votes[i], w * self.toxic[i], w])
            while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
                _, high, y, w = pools.pop()
                pools[-1] = [pools[-1][0], high, pools[-1][2] + y, pools[-1][3] + w]
        self.levels = np.array([p for lo, hi, _, _ in pools for p in (lo, hi)])
        self.scores = np.array([y / w for _, _, y, w in pools for _ in (0, 1)])

    def score(self, near: list[tuple[float, int]]) -> float:
        vote = self.vote(near)
        return float(np.interp(vote, self.levels, self.scores)) if len(self.levels) else vote


class Reader:
    """Term counts of texts; pieces met before are looked up, in a table of bounded size."""

    def __init__(self, terms: dict[str, int]):
        outer = self

        class Known(dict):
            def __missing__(self, piece):
                if len(self) > 300_000:
                    self.clear()
                self[piece] = found = tuple(outer.terms[t] for t in terms_of(piece) if t in outer.terms)
                return found

        self.terms, self.known = terms, Known()

    def counts(self, text: str | None) -> Counter:
        return Counter(t for found in filter(None, map(self.known.__getitem__, (text or "").lower().split())) for t in found)


def fit(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Index:
    """Examples from documents (doc_id, text) and labels (doc_id, toxic): about ``per_label`` documents of each label.

    Of several labels of a document the highest counts; null labels, null texts and labels without a document are passed over.
    The drawn ids, whose number per_label bounds, are broadcast, so that no other text is moved.
    """
    spark = small_batches(documents.sparkSession)
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn, counts = bounded_sample(marks, "toxic", per_label)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).dropna()
    sample = settle(texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic"), "examples")
    schema = pa.schema([("term", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def run(parts):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches(parts):
            for text, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                seen[label].update({t for p in set(text.lower().split()) for t in terms_of(p)})
        terms = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(terms), 50_000):
            block = terms[i : i + 50_000]
            yield out(schema, block, [seen[0][t] for t in block], [seen[1][t] for t in block])

    drawn = {r[0]: r[1] for r in sample.groupBy("toxic").agg(F.count("*")).collect()}
    n0, n1 = drawn.get(0, 0), drawn.get(1, 0)
    found = sample.mapInArrow(run, "term string, clean bigint, toxic bigint").groupBy("term").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))

    def part(x: str, n: str, share: str) -> str:
        return f"(case when {x} > 0 then {x} * ln({x} / ({n} * {share})) else 0 end)"

    share = f"((a + b) / {max(1, n0 + n1)})"
    ratio = "2 * (" + " + ".join([part("a", str(n0), share), part("b", str(n1), share), part(f"({n0} - a)", str(n0), f"(1 - {share})"), part(f"({n1} - b)", str(n1), f"(1 - {share})")]) + ")"
    apart = f"greatest((a + 0.5) / {n0 + 1}, (b + 0.5) / {n1 + 1}) >= {LIFT} * least((a + 0.5) / {n0 + 1}, (b + 0.5) / {n1 + 1})"
    chosen = found.filter(f"a + b >= {SEEN} and {ratio} >= {RATIO} and {apart}").orderBy("term").select("term", (F.col("a") + F.col("b")).alias("n")).toPandas()
    terms = {t: i for i, t in enumerate(chosen["term"])}
    idf = np.log((n0 + n1 + 1) / (chosen["n"].to_numpy(float) + 1)) + 1

    fields = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
    shared = spark.sparkContext.broadcast(terms)

    def vectors(parts):
        reader = Reader(shared.value)
        for b in batches(parts):
            found = [reader.counts(x) for x in b.column(1).to_pylist()]
            yield out(fields, b.column(0), b.column(2), [sorted(c) for c in found], [[c[t] for t in sorted(c)] for c in found])

    examples = sample.mapInArrow(vectors, "doc_id bigint, toxic int, terms array<bigint>, counts array<bigint>").collect()  # at most the sample
    examples.sort(key=lambda r: (r["terms"], r["counts"], r["doc_id"] or 0))  # like ones lie in one block
    toxic = np.array([r["toxic"] for r in examples], float)
    stands = {y: counts.get(y, 0) / max(1, drawn.get(y, 0)) for y in (0, 1)}
    index = Index(terms, idf, np.array([r["doc_id"] or 0 for r in examples], np.int64), toxic, np.array([stands[int(y)] for y in toxic]), counts.get(1, 0) / max(1, sum(counts.values())))
    rows = [index.vector(dict(zip(r["terms"], r["counts"]))) for r in examples]
    index.fill(rows)
    votes = np.array([index.vote(index.nearest(t, v, NEIGHBOURS, i)) for i, (t, v) in enumerate(rows)])
    index.calibrate(votes)
    return index


def score(df: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """The frame with toxicity (0 to 1) and evidence (nearest examples: doc_id, similarity, toxic) instead of such columns.

    A text without known terms, an empty and a null one have no neighbours and get the calibrated prior; without examples
    that is 0. Rows stay as they are, repeated ones too.
    """
    spark = small_batches(df.sparkSession)
    shared = spark.sparkContext.broadcast(index)
    kept = [c for c in df.columns if c not in ("toxicity", "evidence")]
    source = df.select(F.col(f"`{text}`").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in kept])
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema[1:])
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(parts):
        ix = shared.value
        reader, told = Reader(ix.terms), {}
        for b in batches(parts):
            scores, near_ones = [], []
            for x in b.column(0).to_pylist():
                counts = reader.counts(x)
                key = tuple(sorted(counts.items()))
                if key not in told:
                    if len(told) > 20_000:
                        told.clear()
                    near = ix.nearest(*ix.vector(counts), NEIGHBOURS) if counts else []
                    told[key] = (ix.score(near), [(int(ix.ids[i]), s, int(ix.toxic[i])) for s, i in near])
                scores.append(told[key][0])
                near_ones.append([dict(zip(("doc_id", "similarity", "toxic"), n)) for n in told[key][1]])
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(scores, pa.float64()), pa.array(near_ones, evidence)], names=[*kept, "toxicity", "evidence"])

    return source.mapInArrow(run, fields + "toxicity double, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>")
