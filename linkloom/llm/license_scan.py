"""License scans: fixed phrases, and an exact containment join between license templates and text blocks.

A block is a line, or a run of consecutive lines just long enough for the template wherever in its first line that
begins: the fewest lines of which those after the first hold as many words as the template, or all up to the end of the
paragraph. Lines without a word part paragraphs. So a notice is found however it is wrapped.

The join orders tokens by their frequency in the whole corpus, rarest first. A block that holds at least CONTAINMENT of a
template's tokens must hold one of the first |T| - ceil(t|T|) + 1 tokens of the template in that order (prefix filter),
has at least ceil(t|T|) tokens (length filter), and from the place of its first common prefix token on both sides must
still have enough tokens left (positional filter). What passes is verified by counting, so the join is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTAINMENT = 0.8
# Base phrases with their labels, and templates with theirs (public notices that stand in one line).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "mit": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc0": ["To the extent possible under law the author has waived all copyright and related rights to this work"],
    "reserved": ["Copyright holder. All rights reserved"],
}

#: Bytes that are no part of a word become spaces; bytes from 0x80 on belong to characters that are.
_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_WORDS).split()


def template_sets() -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(words_of(t.encode()))) for label, texts in TEMPLATES.items() for t in texts]


def token_counts(docs: DataFrame) -> dict[bytes, int]:
    """In how many documents of the whole table each template token stands: the global order. As many rows as there are template tokens reach the driver."""
    vocabulary = frozenset().union(*(s for _, s in template_sets()))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                n.update(vocabulary.intersection(words_of(text)))
        if n:
            yield pd.DataFrame({"token": list(n), "n": list(n.values())})

    rows = docs.select(_bytes().alias("text")).mapInPandas(counted, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(vocabulary, 0) | {bytes(r["token"]): r["n"] for r in rows}


def _bytes():
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


class ContainmentIndex:
    """The templates, ordered and indexed by their prefixes."""

    def __init__(self, counts: dict[bytes, int], threshold: float = CONTAINMENT):
        self.rank = {t: k for k, (_, t) in enumerate(sorted((counts.get(t, 0), t) for t in frozenset().union(*(s for _, s in template_sets()))))}
        self.templates, self.by_prefix = [], {}
        self.lengths = [len(words_of(t.encode())) for texts in TEMPLATES.values() for t in texts]
        for label, tokens in template_sets():
            order = sorted(tokens, key=self.rank.__getitem__)
            need = math.ceil(threshold * len(order) - 1e-9)
            at = len(self.templates)
            self.templates.append((label, order, {t: i for i, t in enumerate(order)}, need))
            for t in order[: len(order) - need + 1]:
                self.by_prefix.setdefault(t, []).append(at)
        self.prefix_tokens = frozenset(self.by_prefix)

    def matches(self, words: list[bytes]) -> dict[str, float]:
        """label -> containment, of the templates that the block holds."""
        found: dict[str, float] = {}
        for at, share in self.held(words).items():
            label = self.templates[at][0]
            found[label] = max(found.get(label, 0.0), share)
        return found

    def held(self, words: list[bytes]) -> dict[int, float]:
        """Number of the template -> containment."""
        hit = self.prefix_tokens.intersection(words)
        if not hit:
            return {}
        line = sorted((self.rank[w] for w in set(words) if w in self.rank))
        place = {r: i for i, r in enumerate(line)}
        found: dict[int, float] = {}
        for at in {a for t in hit for a in self.by_prefix[t]}:
            _, order, index, need = self.templates[at]
            if len(line) < need:  # length filter; only tokens of templates can be common
                continue
            first = min((self.rank[t] for t in hit if t in index))
            if min(sum(self.rank[t] >= first for t in order), len(line) - place[first]) < need:  # positional filter
                continue
            common = sum(self.rank[t] in place for t in order)
            if common >= need:
                found[at] = common / len(order)
        return found

    def wrapped(self, lines: list[list[bytes]]) -> dict[str, float]:
        """label -> containment, of the templates that a run of the paragraph's lines holds. What the paragraph lacks no run has."""
        found: dict[str, float] = {}
        for at in self.held([w for line in lines for w in line]):
            label, order, index, need = self.templates[at]
            inside: Counter = Counter()
            most, end, after = 0, 0, 0  # lines[start:end] are inside; those past the first hold `after` words
            for start in range(len(lines)):
                if end > start:
                    after -= len(lines[start])
                while end < len(lines) and (end <= start or after < self.lengths[at]):
                    inside.update(w for w in lines[end] if w in index)
                    after += len(lines[end]) if end > start else 0
                    end += 1
                most = max(most, len(inside))
                for w in lines[start]:
                    if w in inside:
                        inside[w] -= 1
                        if not inside[w]:
                            del inside[w]
                if end == len(lines) and most == len(order):
                    break
            if most >= need:
                found[label] = max(found.get(label, 0.0), most / len(order))
        return found


def phrase_places(words: list[bytes]) -> tuple[int, int | None, int | None, set[str]]:
    """Number of places, smallest and largest start in words, and labels of the fixed phrases."""
    joined, n, first, last, labels = b" " + b" ".join(words) + b" ", 0, None, None, set()
    for phrase, label in PHRASES.items():
        sought, at, k, counted = b" " + phrase.encode() + b" ", -1, 0, 0
        while (at := joined.find(sought, at + 1)) >= 0:
            k, counted = k + joined.count(b" ", counted, at), at
            n, first, last = n + 1, k if first is None else min(first, k), k if last is None else max(last, k)
            labels.add(label)
    return n, first, last, labels


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def license_scan(docs: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    labels joins the base labels with those of templates that a block of the text contains; score is the largest containment,
    1 if a fixed phrase stands in the text, 0 if nothing was found. Null texts count as empty: no words, null
    places, empty labels, score 0. Repeated rows come out as often as they come in; an empty table gives no rows; other
    columns are not read. The templates are a fixed list, so they travel with the code; nothing else is broadcast.
    """
    counts = token_counts(docs)

    @F.pandas_udf(SCHEMA)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = ContainmentIndex(counts, threshold)
        for texts in batches:
            rows = []
            for text in texts:
                lines = text.lower().translate(_LINES).split(b"\n")
                words, found, paragraph = [], {}, []
                for line in [*lines, b""]:
                    own = line.split()
                    words += own
                    shares = [*index.matches(own).items()]
                    if own:
                        paragraph.append(own)
                    else:
                        shares += index.wrapped(paragraph).items() if len(paragraph) > 1 else []
                        paragraph = []
                    for label, share in shares:
                        found[label] = max(found.get(label, 0.0), share)
                n, first, last, base = phrase_places(words)
                rows.append((len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(base | found.keys())), 1.0 if base else max(found.values(), default=0.0)))
            out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select("doc_id", scan(_bytes()).alias("found")).select("doc_id", "found.*")


#: As _WORDS, but lines stay apart.
_LINES = bytes(0x0A if b == 0x0A else _WORDS[b] for b in range(256))
