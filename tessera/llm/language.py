"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters and marks counts as a space, and all runs of one to three characters are hashed
into a fixed number of buckets. Counts per language and bucket come from one aggregation; the matrix of log probabilities
(buckets x languages) is broadcast, and batches of texts are scored as sparse sums of its rows.

The score compares languages with each other; how well a text fits at all is told by its fit: the mean log probability of its
n-grams in its language, as a share of what texts of that language usually gain over evenly spread n-grams. What is usual
is learned from the training rows as well, each half of them (by a hash of the text) under the counts of the other half.
"""

from __future__ import annotations

import unicodedata
import warnings
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CLASSES, batches, bounded_sample, out, small_batches

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Rows of each language that the model is fitted on, about; all if there are fewer.
PER_LANGUAGE = 4000
#: n-grams that a text counts for at most in its score; neighbouring n-grams aren't independent.
EVIDENCE = 40
UNKNOWN = "und"
#: A text of a lower fit is in none of the languages, even with two standard errors of its mean in its favour.
FITS = 0.5


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # buckets x languages
    usual: np.ndarray  # mean log probability of an n-gram in texts of each language; nan where two halves of them are missing
    spread: np.ndarray  # and its standard deviation
    unlearned: tuple[int, int] = (0, 0)  # languages beyond CLASSES, and their rows


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: whether it is a letter, and the code that stands for it (letters and marks: itself)."""
    kinds = [unicodedata.category(chr(i))[0] for i in range(0x10000)]
    letter = np.array([k == "L" for k in kinds])
    code = np.where([k in "LM" for k in kinds], np.arange(0x10000), 32).astype(np.uint32)
    return letter, code


def ngrams(texts: list[str | None]):
    """Blocks of texts: the first text's number, buckets of all n-grams, where each text's begin, and whether it has letters."""
    letter, code = letters()
    i = 0
    while i < len(texts):
        first, codes, size = i, [], 0
        while i < len(texts) and (size < 300_000 or not codes):
            x = np.frombuffer(f" {texts[i] or ''} ".lower().encode("utf-32-le", "replace"), "<u4")
            codes.append(x)
            size += len(x)
            i += 1
        length = np.array([len(x) for x in codes])
        flat = np.concatenate(codes)
        low = np.minimum(flat, 0xFFFF)
        far = flat > 0xFFFF
        has = letter[low] & ~far
        if far.any():
            has[far] = [chr(c).isalpha() for c in flat[far]]
        starts = np.cumsum(length) - length
        lettered = np.logical_or.reduceat(has, starts)
        flat = np.where(far, flat, code[low]).astype(np.uint32)
        space = flat == 32
        left = np.repeat(starts + length, length) - np.arange(len(flat))  # characters from here to the text's end
        owner = np.repeat(np.arange(len(codes)), length)
        buckets, owners = [], []
        for n in ORDERS:
            h = np.full(len(flat) - n + 1, n * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
            blank = np.ones(len(h), bool)
            for k in range(n):
                h = (h ^ flat[k : len(h) + k]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
                blank &= space[k : len(h) + k]
            good = ~blank & (left[: len(h)] >= n)
            buckets.append((h[good] * np.uint32(0xC2B2AE35)) >> np.uint32(16))
            owners.append(owner[: len(h)][good])
        yield first, np.concatenate(buckets).astype(np.int64), np.concatenate(owners), lettered


def fit(df: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` rows of each language; rows with a null text or language are left out. No rows give a model without languages.

    Copies of a text are drawn one by one if the rows have a ``doc_id``. Of more than CLASSES languages, those with most rows are
    learned; the model and a warning tell how many languages and rows are not.
    """
    spark = small_batches(df.sparkSession)
    ids = [F.col("doc_id").alias("_id")] if "doc_id" in df.columns else []
    rows = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), *ids).dropna(subset=["text", "lang"])
    sample, counts = bounded_sample(rows, "lang", per_language)
    everything = rows.groupBy("lang").agg(F.count("*").alias("n")).agg(F.count("*"), F.sum("n")).first() if len(counts) == CLASSES else (len(counts), sum(counts.values()))
    unlearned = everything[0] - len(counts), everything[1] - sum(counts.values())
    if unlearned[0]:
        warnings.warn(f"{unlearned[0]} languages with {unlearned[1]} rows aren't learned; the {CLASSES} with most rows are", stacklevel=2)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64()), ("half", pa.int64())])

    def run(parts):
        seen: dict[str, np.ndarray] = {}
        for b in batches(parts):
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            half = [zlib.crc32(x.encode("utf-8", "replace")) & 1 for x in texts]
            for value, h in set(zip(langs, half)):
                total = seen.setdefault(value, np.zeros((2, BUCKETS), np.int64))[h]
                for _, bucket, _, _ in ngrams([x for x, y, z in zip(texts, langs, half) if y == value and z == h]):
                    total += np.bincount(bucket, minlength=BUCKETS)
        for value, halves in seen.items():
            total = halves.sum(0)
            there = np.flatnonzero(total)
            yield out(schema, [value] * len(there), there, total[there], halves[1, there])

    found = sample.mapInArrow(run, "lang string, bucket int, n bigint, half bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("half").alias("half"))
    languages = sorted(counts)
    table = found.toPandas()  # at most languages x buckets
    halves = np.zeros((max(1, len(languages)), 2, BUCKETS))
    if len(table):
        column = {x: i for i, x in enumerate(languages)}
        at = table["lang"].map(column).to_numpy(), slice(None), table["bucket"].to_numpy()
        halves[at] = np.stack([table["n"] - table["half"], table["half"]], 1)
    matrix = np.stack([logs(x.sum(0)) for x in halves], 1)
    usual, spread = np.array([moments(x) for x in halves]).T
    prior = np.log(np.array([counts[x] for x in languages], float) / max(1, sum(counts.values())))
    return Model(languages, prior, matrix.astype(np.float32), usual, spread, unlearned)


def logs(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of buckets, smoothed by half a count."""
    return np.log(counts + 0.5) - np.log(counts.sum() + 0.5 * len(counts))


def moments(halves: np.ndarray) -> tuple[float, float]:
    """Mean and standard deviation of the log probabilities of each half's n-grams under the other half's counts."""
    if not halves.sum(1).all():
        return np.nan, np.nan
    under, share = np.stack([logs(halves[1]), logs(halves[0])]), halves / halves.sum()
    mean = (share * under).sum()
    return mean, np.sqrt(max((share * under**2).sum() - mean**2, 0.0))


def fit_of(model: Model, language: np.ndarray, mean: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The fit of texts with these means over so many n-grams, two standard errors granted; nan where nothing usual is known."""
    even, usual = -np.log(BUCKETS), model.usual[language]
    error = model.spread[language] / np.sqrt(many / len(ORDERS))  # n-grams that begin at one place are one observation
    return (mean + 2 * error - even) / np.where(usual > even, usual - even, np.nan)


def predict(df: DataFrame, model: Model, text: str = "text", floor: float | None = None) -> DataFrame:
    """The frame with lang_pred and score (0 to 1, the language's share of the evidence) instead of columns of those names.

    The language is the likeliest by all n-grams; of these, the score counts EVIDENCE at most.

    A null text and one without letters are ``und`` with score 0, as is every text if no language was learned. With a
    ``floor``, so is a text whose fit to its language is below it, two standard errors granted; languages of which no two
    halves of training texts are there reject none. Of equally likely languages the first by name is taken. Rows stay as they
    are, repeated ones too.
    """
    spark = small_batches(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    source = df.select(F.col(f"`{text}`").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in kept])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[1:])

    def run(parts):
        m = shared.value
        for b in batches(parts):
            texts = b.column(0).to_pylist()
            best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            known = np.zeros(len(texts), bool)
            for first, bucket, owner, lettered in ngrams(texts) if m.languages else ():
                n = len(lettered)
                total = np.stack([np.bincount(owner, m.log_probability[bucket, k], n) for k in range(len(m.languages))], 1)
                many = np.maximum(np.bincount(owner, minlength=n), 1)
                mean = total / many[:, None]
                top = (total + m.log_prior).argmax(1)
                total = total * (np.minimum(many, EVIDENCE) / many)[:, None] + m.log_prior
                total = np.exp(total - total.max(1, keepdims=True))
                total /= total.sum(1, keepdims=True)
                if floor is not None:
                    lettered &= ~(fit_of(m, top, mean[np.arange(n), top], many) < floor)
                best[first : first + n], score[first : first + n], known[first : first + n] = top, total[np.arange(n), top], lettered
            names = [m.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))], names=[*kept, "lang_pred", "score"])

    return source.mapInArrow(run, f"{fields}, lang_pred string, score double" if kept else "lang_pred string, score double")
