"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame functions only.

A text's words are cut into overlapping blocks, so that every stretch of up to STEP words lies in one. A template is met by a
block that holds at least a given share of the template's distinct words. The words of all templates are ordered by how many
documents have them, rarest first, counted over all documents. Of a template of n words of which o have to be there, a block
that meets it has one among the first n - o + 1 in that order (prefix filter); the first one it has, at place i, must leave
n - i >= o (positional filter); and the block must have o distinct words (length filter). Whatever passes is compared whole.

Templates and blocks never meet as a product: a document's words are looked up in the prefixes, which are literals of the
plan, and only blocks around such a word are looked at. Each row is by itself, so no group can be hot.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower

#: Fixed: the phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def short(label: str, text: str, missing: int, naming: str) -> list[tuple[str, float, str]]:
    """A short notice as sets to be there in full: any so many of its words may be missing, but none that names the license."""
    own, kept = list(dict.fromkeys(text.split(" "))), naming.split(" ")
    free = [w for w in own if w not in kept]
    return [(label, 1.0, " ".join(w for w in own if w not in gone)) for gone in combinations(free, missing)]


#: Words that a scan looks for as sets: the label, the share that has to be there, and a notice's words. First the customary
#: short forms by which authors refer to a license, then passages of license texts and standard headers, of up to STEP words
#: each so that a block holds them. Passages that several licenses have (disclaimers) are no templates.
NOTICES = [
    *short("apache", "licensed under the apache license version 2 0", 1, "apache"),
    *short("mit", "released under the mit license", 1, "mit"),
    ("gpl", 1.0, "gnu general public license"),
    ("gpl", 1.0, "licensed gnu general public"),
    ("gpl", 1.0, "gnu general public version 3"),
    ("cc-by-nc", 1.0, "licensed under cc by nc 4 0"),
    ("cc-by", 1.0, "licensed under cc by 4 0"),
    ("bsd", 0.8, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("lgpl", 0.9, "gnu lesser general public license"),
    ("mpl", 1.0, "mozilla public license"),
    *short("mpl", "subject to the terms of the mozilla public license", 1, "mozilla subject to the terms of"),
    ("mit", 0.9, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", 0.9, "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished"),
    ("isc", 1.0, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("bsd", 0.9, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 0.9, "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", 0.85, "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache", 0.9, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", 1.0, "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", 0.9, "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", 1.0, "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl", 0.9, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", 0.9, "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("cc-by", 1.0, "creative commons attribution 4 0 international"),
    ("cc-by-nc", 1.0, "creative commons attribution noncommercial 4 0 international"),
    ("cc-by-sa", 1.0, "creative commons attribution sharealike 4 0 international"),
    ("cc-by-sa", 1.0, "licensed under cc by sa 4 0"),
]
#: Fixed: what lies between words.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words from one block's beginning to the next; a block has twice as many.
STEP = 32


def words(text: str) -> Column:
    whole = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.array_remove(F.split(whole, GAPS), "")


def needed(share: float, size: int) -> int:
    """The smallest number of words that is the share of a template."""
    return -int(-round(share * 1000) * size // 1000)


def templates() -> list[tuple[str, float, list[str]]]:
    """(label, share, distinct words); phrases come first and are to be there in full."""
    rows = [(label, 1.0, phrase) for phrase, label in PHRASES.items()] + NOTICES
    return [(label, share, list(dict.fromkeys(t.split(" ")))) for label, share, t in rows]


def frequencies(df: DataFrame, text: str = "text") -> dict[str, int]:
    """In how many documents each word of a template is; at most one row per such word comes to the driver."""
    vocabulary = sorted({w for _, _, ws in templates() for w in ws})
    own = F.explode(F.array_intersect(words(text), F.array(*map(F.lit, vocabulary))))
    counted = {r[0]: r[1] for r in df.select(own.alias("w")).groupBy("w").agg(F.count("*")).collect()}
    return {w: counted.get(w, 0) for w in vocabulary}


def strings(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def scan(df: DataFrame, often: dict[str, int], text: str = "text") -> DataFrame:
    """The frame with n_words, places (start and label of each phrase's places), matches (label, first word and score of each block
    that meets a notice) and score (1 with a place, else the largest share among the notices met) instead of such columns.

    ``often`` orders the words; any order gives the same result. Null and empty texts have no words, no matches and score 0.
    Rows stay as they are, repeated ones too.
    """
    rows = []
    for k, (label, share, own) in enumerate(templates()):
        own = sorted(own, key=lambda w: (often.get(w, 0), w))
        o = needed(share, len(own))
        rows.append((k, label, own, o, own[: len(own) - o + 1]))
    heads = sorted({w for *_, prefix in rows for w in prefix})
    phrases = list(PHRASES)
    table = "array(" + ", ".join(f"named_struct('id', {k}, 'label', '{label}', 'own', {strings(own)}, 'o', {o}, 'prefix', {strings(prefix)})" for k, label, own, o, prefix in rows) + ")"
    phrase = "array(" + ", ".join(strings(p.split(" ")) for p in phrases) + ")"
    kept = [c for c in df.columns if c not in ("n_words", "places", "matches", "score")]
    found = df.select(*[F.col(f"`{c}`") for c in kept], words(text).alias("_words"))
    # Places of words that are in a prefix; most texts have none or few.
    found = found.withColumn("_hits", F.expr(f"filter(transform(_words, (w, i) -> if(w in ({', '.join(map(repr, heads))}), i, cast(null as int))), i -> i is not null)"))
    blocks = f"array_sort(array_distinct(filter(flatten(transform(_hits, i -> array(i div {STEP} - 1, i div {STEP}))), b -> b >= 0)))"
    found = found.withColumn("_blocks", F.expr(blocks))
    held = f"array_distinct(slice(_words, cast(b * {STEP} + 1 as int), {2 * STEP}))"
    found = found.withColumn("_blocks", F.expr(f"transform(_blocks, b -> named_struct('b', b, 'held', {held}))"))
    # Candidates pass the length filter, the prefix filter and the positional filter; ``common`` is the overlap.
    first = "array_position(transform(t.own, w -> array_contains(k.held, w)), true)"
    passes = f"size(k.held) >= t.o and arrays_overlap(k.held, t.prefix) and size(t.own) - {first} + 1 >= t.o"
    pair = f"transform(filter({table}, t -> {passes}), t -> named_struct('id', t.id, 'label', t.label, 'o', t.o, 'b', k.b, 'common', size(array_intersect(t.own, k.held)), 'size', size(t.own)))"
    found = found.withColumn("_pairs", F.expr(f"flatten(transform(_blocks, k -> {pair}))"))
    met = "filter(_pairs, p -> p.common >= p.o)"
    # An exact check of the blocks that hold all words of a phrase: the places, in the block's first half, where they stand in order.
    places = f"""flatten(transform(filter({met}, p -> p.id < {len(phrases)}), p -> transform(
        filter(sequence(p.b * {STEP}, p.b * {STEP} + {STEP} - 1),
               i -> slice(_words, cast(i + 1 as int), size({phrase}[p.id])) = {phrase}[p.id]),
        i -> named_struct('start', cast(i as bigint), 'label', p.label))))"""
    found = found.withColumn("places", F.expr(f"array_sort({places})"))
    found = found.withColumn("matches", F.expr(f"array_distinct(transform(filter({met}, p -> p.id >= {len(phrases)}), p -> named_struct('label', p.label, 'start', cast(p.b * {STEP} as bigint), 'score', p.common / p.size)))"))
    found = found.withColumn("score", F.expr("cast(if(size(places) > 0, 1, coalesce(array_max(matches.score), 0)) as double)"))
    return found.withColumn("n_words", F.size("_words").cast("bigint")).select(*kept, "n_words", "places", "matches", "score")
