"""Phrase collocations of two and three words, counted in stripes.

A stripe is a prefix with a counter of the words that follow it. A batch of texts yields the stripe of the empty prefix, whose
counter counts the words, and the stripes of all two-word prefixes, in which the end of a piece counts as a word too. Stripes
with the same prefix are merged by adding their counters element by element. Everything else is read off the merged stripes:
a prefix's total is its own count, entries that are frequent enough are its extensions, and the largest of them is what may
subsume the prefix. Entries of the stripe (a, b) also say what may subsume (b, c) from the left.

Stripes travel in bundles: the stripes of one batch of texts whose prefixes fall into one of many buckets are one row, a line
for each entry, so that all stripes of a prefix meet and those of a common first word are spread. A task reads its buckets in
order and merges a bucket's entries as they come; it holds what differs among them, not what occurs.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import FOLD, MIX, batches, digests, only, out, settle, small_batches, text_bytes

# These end a piece, and within pieces the space and the tab separate words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
UNKNOWN = "und"
#: Words that are counted together before their stripes leave a task; bounds a worker's memory.
WORDS = 1_200_000
#: Buckets of stripes for each shuffle partition: a task merges one after another.
SPREAD = 4

BREAK, CUT = np.zeros(256, bool), np.zeros(256, bool)
BREAK[list(ENDS)] = True
CUT[list(ENDS + BLANKS)] = True
_SCHEMA = pa.schema([("bucket", pa.int32()), ("entries", pa.string())])


def words_of(texts: pa.Array, langs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a batch of texts, lower-cased, with the number of their piece and of their text's language."""
    raw, offsets = text_bytes(texts)
    word = ~CUT[raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    row_at = offsets[:-1][np.diff(offsets) > 0]
    first[row_at] = word[row_at]
    last[row_at[row_at > 0] - 1] = word[row_at[row_at > 0] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends = np.zeros(len(end) + 1, np.int32)
    np.cumsum(end - begin, out=ends[1:])
    kept = np.ascontiguousarray(raw[word])
    words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(kept))
    row = np.searchsorted(offsets, begin, "right") - 1
    piece = np.cumsum(BREAK[raw], dtype=np.int64)[begin] + row if len(begin) else begin
    return words, piece, langs[row]


def stripes_of(words: pa.Array, piece: np.ndarray, lang: np.ndarray, names: list[str], buckets: int) -> Iterator[pa.RecordBatch]:
    """Bundles of the stripes of a run of words."""
    coded = words.dictionary_encode()
    ids, values = coded.indices.to_numpy().astype(np.int64) + 1, coded.dictionary
    d, size = len(values) + 1, len(ids)
    same = np.zeros(size + 2, bool)
    same[: size - 1] = piece[1:] == piece[:-1]
    after = np.concatenate([ids, np.zeros(2, np.int64)])
    one = np.where(same[:size], after[1 : size + 1], 0)
    two = np.where(same[:size] & same[1 : size + 1], after[2 : size + 2], 0)

    pairs, pair = np.unique((lang * d + ids) * d + one, return_inverse=True)
    entries, n = np.unique(pair * d + two, return_counts=True)
    at, third = np.divmod(entries, d)
    head, second = np.divmod(pairs[at], d)
    own, first = np.divmod(head, d)
    # the stripe of the empty prefix: every word, and under the empty word the number of words
    plain, n_plain = np.unique(lang * d + ids, return_counts=True)
    langs, n_all = np.unique(lang, return_counts=True)
    zero = np.zeros(len(plain) + len(langs), np.int64)
    own = np.concatenate([own, plain // d, langs])
    first, second = np.concatenate([first, zero]), np.concatenate([second, zero])
    third = np.concatenate([third, plain % d, np.zeros(len(langs), np.int64)])
    n = np.concatenate([n, n_plain, n_all]).astype(np.int32)

    def hashed(strings: pa.Array) -> np.ndarray:
        raw, offsets = text_bytes(strings, fold=False)
        return digests(raw, offsets[:-1], np.diff(offsets))[0]

    word_hash = np.concatenate([[MIX[3]], hashed(values)])
    h = (hashed(pa.array(names))[own] ^ word_hash[first]) * MIX[1]
    h = ((h ^ (h >> np.uint64(31))) + word_hash[np.where(first > 0, second, third)]) * MIX[2]
    bucket = ((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    strings, quoted = pa.concat_arrays([pa.array([""]), values]), pa.array([quote(x, safe="") for x in names])
    bounds = np.append(starts, len(bucket)).astype(np.int32)
    for a in range(0, len(starts), 1024):  # rows of a batch
        cut = bounds[a : a + 1025]
        rows = order[cut[0] : cut[-1]]
        # "lang first second next n": none of them holds a space
        words = [strings.take(pa.array(x[rows])) for x in (first, second, third)]
        lines = pc.binary_join_element_wise(quoted.take(pa.array(own[rows])), *words, pa.array(n[rows]).cast(pa.string()), " ")
        yield out(_SCHEMA, bucket[starts[a : a + 1024]].astype(np.int32), pc.binary_join(pa.ListArray.from_arrays(cut - cut[0], lines), "\n"))


Entries = tuple[np.ndarray, pa.Array, pa.Array, pa.Array, np.ndarray]


def read_entries(bundles: pa.Array, names: dict[str, int]) -> Entries:
    """The language, by its number in ``names``, first, second and next word and count of all entries of some bundles."""
    raw, _ = text_bytes(pc.binary_join_element_wise(bundles, "", "\n"), fold=False)
    ends = np.flatnonzero((raw == 32) | (raw == 10)).reshape(-1, 5)
    begins = np.concatenate([[0], ends.ravel()[:-1] + 1]).reshape(-1, 5)

    def field(i: int) -> pa.Array:
        size = ends[:, i] - begins[:, i]
        mark = np.zeros(len(raw) + 1, np.int8)
        some = size > 0
        mark[begins[some, i]] = 1
        mark[ends[some, i]] = -1
        own = raw[np.cumsum(mark[:-1], dtype=np.int8).view(bool)]
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(own))

    coded = field(0).dictionary_encode()
    number = np.array([names.setdefault(unquote(x), len(names)) for x in coded.dictionary.to_pylist()], np.int64)
    return number[coded.indices.to_numpy()], field(1), field(2), field(3), field(4).cast(pa.int64()).to_numpy()


def merge_entries(parts: list[Entries]) -> tuple[Entries, np.ndarray]:
    """Each entry once, with the sum of its counts, sorted so that a prefix's entries are neighbours; and where prefixes begin."""
    size = [len(p[0]) for p in parts]
    lang, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[4] for p in parts])
    coded = pa.concat_arrays([p[i] for i in (1, 2, 3) for p in parts]).dictionary_encode()
    ids, d = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    first, second, third = ids.reshape(3, sum(size))
    pairs, pair = np.unique((lang * d + first) * d + second, return_inverse=True)
    key = pair * d + third
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.add.reduceat(n[order], starts)
    at, third = np.divmod(key[starts], d)
    head, second = np.divmod(pairs[at], d)
    lang, first = np.divmod(head, d)
    words = [coded.dictionary.take(pa.array(x)) for x in (first, second, third)]
    return (lang, *words, n), np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))


_READ = pa.schema([("lang", pa.string()), ("first", pa.string()), ("second", pa.string()), ("next", pa.string()), ("n", pa.int64()), ("total", pa.int64()), ("inside", pa.int64())])


def read_stripes(parts: list[Entries], names: list[str], least: int) -> pa.RecordBatch:
    """What merged stripes say: words and number of words, prefixes with their total, and the entries of prefixes."""
    (lang, first, second, third, n), starts = merge_entries(parts)
    sizes = np.diff(np.append(starts, len(n)))
    total = np.repeat(np.add.reduceat(n, starts), sizes)
    word, ends = pc.equal(first, "").to_numpy(False), pc.equal(third, "").to_numpy(False)
    extends = ~word & ~ends & (n >= least)
    inside = np.repeat(np.maximum.reduceat(np.where(extends, n, 0), starts), sizes)
    heads = np.zeros(len(n), bool)
    heads[starts] = True
    heads &= ~word & (total >= least) & ~pc.equal(second, "").to_numpy(False)
    plain = np.flatnonzero(word & (ends | (n >= least)))
    head, entry = np.flatnonzero(heads), np.flatnonzero(extends)
    rows = np.concatenate([plain, head, entry])
    is_head = np.zeros(len(rows), bool)
    is_head[len(plain) : len(plain) + len(head)] = True
    take = pa.array(rows)
    following = pa.array(np.array(third.take(take).to_pylist(), object), pa.string(), mask=is_head)
    count = np.where(is_head, total[rows], n[rows])
    langs = pa.array(names).take(pa.array(lang[rows]))
    best = pa.array(inside[rows], pa.int64(), mask=inside[rows] == 0)
    return out(_READ, langs, first.take(take), second.take(take), following, count, total[rows], best)


def stripes(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, first, second, next, n, total, inside): what the merged stripes of all texts say.

    Rows with an empty ``first`` are words, ``next``, with their count n; an empty ``next`` stands for all words. The others are
    prefixes of two words, with n their own count, where ``next`` is null, and their entries else. Of words, prefixes and
    entries those with a count of ``least`` or more are given, of entries none for the end of a piece; ``inside`` is the largest
    entry given for a prefix. A null language is ``und``, null and empty texts have no words, repeated rows count again, and
    other columns are ignored.
    """
    spark = small_batches(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = SPREAD * partitions

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = [], {}

        def counted():
            words = pa.concat_arrays([w for w, _, _ in held])
            piece, at = [], 0
            for _, p, _ in held:
                piece.append(p + at)
                at += int(p[-1]) + 2 if len(p) else 0
            yield from stripes_of(words, np.concatenate(piece), np.concatenate([x for _, _, x in held]), list(names), buckets)

        for b in batches(parts):
            size = max(1, b.num_rows * (1 << 22) // max(1 << 22, b.column("text").nbytes))  # rows of about 4 MB
            for i in range(0, b.num_rows, size):
                part = b.slice(i, size)
                langs = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()], np.int64)
                held.append(words_of(part.column("text"), langs))
                if sum(len(w) for w, _, _ in held) >= WORDS:
                    yield from counted()
                    held, names = [], {}
        if sum(len(w) for w, _, _ in held):
            yield from counted()

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, last = [], {}, None
        for b in batches(parts):
            bucket = b.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if sum(len(p[0]) for p in held) >= WORDS:
                    if bucket[i] != last:
                        yield read_stripes(held, list(names), least)
                        held = []
                    else:  # a large bucket: put together what is the same
                        held = [merge_entries(held)[0]]
                last = bucket[i]
                held.append(read_entries(b.column("entries").slice(i, j - i), names))
        if held:
            yield read_stripes(held, list(names), least)

    named = only(docs, text, lang).toDF("text", "lang")
    named = named.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    bundles = named.mapInArrow(run, "bucket int, entries string")
    dealt = bundles.repartitionById(partitions, F.col("bucket") % partitions).sortWithinPartitions("bucket")
    return dealt.mapInArrow(merge, "lang string, first string, second string, next string, n bigint, total bigint, inside bigint")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a^2 / (left * right)), exactly: both sides fit 38 digits up to counts of 10^15, and the quotient a long."""
    square = f"cast({a} as decimal(15,0)) * cast({a} as decimal(15,0))"
    return F.expr(f"cast(cast({square} * 1000000 as decimal(38,0)) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0))) as bigint)")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, count and phrase.

    Candidates are phrases of two and three words that occur at least ``least`` times. The score is that of the cut that
    scores lowest, the first one of equal cuts. Left out are phrases inside a longer candidate that has half of their
    occurrences or more. See ``stripes`` for odd rows; without candidates there are no rows.
    """
    found = settle(stripes(docs, least, text, lang), "stripes")
    single = found.filter("first = ''")
    sizes = single.filter("next = ''").groupBy("lang").agg(F.sum("n").alias("n"))
    word = single.filter("next <> ''").select("lang", F.col("next").alias("word"), F.col("n").alias("f"))

    def counts(column: str, name: str) -> DataFrame:
        return word.select("lang", F.col("word").alias(column), F.col("f").alias(name))

    three = found.filter("first <> '' and next is not null").select("lang", "first", "second", "next", F.col("n").alias("a"), F.col("total").alias("l2"))
    two = found.filter("first <> '' and next is null").select("lang", "first", "second", F.col("total").alias("a"), "inside")
    left = three.groupBy("lang", F.col("second").alias("first"), F.col("next").alias("second")).agg(F.max("a").alias("before"))
    pairs = two.join(left, ["lang", "first", "second"], "left").join(counts("first", "l"), ["lang", "first"]).join(counts("second", "r"), ["lang", "second"])
    pairs = pairs.filter(F.coalesce(100 * F.greatest("inside", "before") < 50 * F.col("a"), F.lit(True)))
    pairs = pairs.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r").withColumn("score", score("a", "l", "r"))

    tails = two.select("lang", F.col("first").alias("second"), F.col("second").alias("next"), F.col("a").alias("r1"))
    triples = three.join(tails, ["lang", "second", "next"]).join(counts("first", "l1"), ["lang", "first"]).join(counts("next", "r2"), ["lang", "next"])
    triples = triples.withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2")})
    lower = F.col("s2") < F.col("s1")
    cut = [F.when(lower, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(name) for c, name in (("l", "l"), ("r", "r"), ("s", "score"))]
    triples = triples.select("lang", F.concat_ws(" ", "first", "second", "next").alias("phrase"), "a", *cut)

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
