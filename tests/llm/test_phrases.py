"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from tessera.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) == 1 or a < least:
            continue
        if len(p) == 2 and any(a3 >= least and p in (q[:2], q[1:]) and 100 * a3 >= 50 * a for (g, q), a3 in f.items() if g == lang and len(q) == 3):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        s, _, left, right = min(cuts, key=lambda c: c[:2])
        found.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in found.items() for i, (s, a, p, left, right) in enumerate(sorted(all_)[:top])}


def made(seed=1, n=1200):
    rng = random.Random(seed)
    words = ["new", "york", "city", "the", "of", "Naïve", "漢字", "x\x00", "é", "a-b", "\xa0", "rare"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!?"]) for _ in range(rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "de", None, "und", ""])))
    hot = "the new york city council met"
    return rows + [(hot, "en")] * 400 + [(None, "en"), ("", "fr"), ("...", "fr"), (" \t\n", None), ("one", "it"), ("long " * 20_000, "lo")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], "text string, lang string, Text string, n int, first string, bucket int").repartition(3)


@pytest.mark.parametrize("words", [400, 1_200_000])
def test_collocations(spark, monkeypatch, words):
    monkeypatch.setattr(collocations, "WORDS", words)
    rows = made()
    got = [tuple(r) for r in collocations.collocations(frame(spark, rows), 10, 25).collect()]
    want = brute(rows, 10, 25)
    assert set(got) == want and len(got) == len(want)
    assert any(r[2].count(" ") == 2 for r in got) and {"und", "en", "de", "lo"} <= {r[0] for r in got}


def test_subsumed_and_equal_scores(spark):
    rows = [("a b c. a b", "x")] * 10 + [("d e f", "x")] * 10 + [("g h. g h i", "x")] * 9
    got = {r.phrase: r for r in collocations.collocations(frame(spark, rows), 10, 100).collect()}
    assert {(*r,) for r in got.values()} == brute(rows, 10, 100)
    assert "d e" not in got and "a b" not in got and "g h" in got  # half of a b is in a b c; g h i is too rare to count
    assert (got["d e f"].l, got["d e f"].r) == (10, 10)


def test_exact_scores(spark):
    big = spark.createDataFrame([(999_999_999_999, 10**12 - 1, 10**12), (3, 7, 9), (10, 10, 10)], "a bigint, l bigint, r bigint")
    got = [r.s for r in big.select(collocations.score("a", "l", "r").alias("s")).collect()]
    assert got == [1_000_000 * a * a // (x * r) for a, x, r in ((999_999_999_999, 10**12 - 1, 10**12), (3, 7, 9), (10, 10, 10))]


def test_merged_stripes(spark, monkeypatch):
    """Stripes of one prefix come together from all batches; their totals are the prefixes' own counts."""
    monkeypatch.setattr(collocations, "WORDS", 7)
    rows = [("p q r. p q s. p q", "x"), ("p q r p", "x")] * 3
    merged = {(r.first, r.second, r.next): (r.n, r.total, r.inside) for r in collocations.stripes(frame(spark, rows), 1).collect()}
    assert {k[2]: v for k, v in merged.items() if k[:2] == ("p", "q")} == {None: (12, 12, 6), "r": (6, 12, 6), "s": (3, 12, 6)}
    assert merged["", "", ""][0] == 36 and merged["", "", "p"][0] == 15 and merged["q", "r", None] == (6, 6, 3)
    assert ("p", "", None) not in merged


def test_nothing_to_count(spark):
    for rows in ([], [(None, None)], [("", "en"), ("one", "en")]):
        assert collocations.collocations(frame(spark, rows)).count() == 0
