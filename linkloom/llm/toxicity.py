"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

The lexicon is learned: word beginnings that labelled toxic texts use far more than clean ones. Texts are folded first
(case, homoglyphs, digits for letters), so a spelling meant to slip through meets the same entry.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, discard, materialize, whole_text

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "a": "аαɑ", "b": "ьƅ", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј", "k": "кκ", "l": "ӏⅼ",
    "m": "мⅿ", "n": "ոη", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "νѵ", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i"}
#: Insults known before any label, and phrases in which such a word insults nobody.
SEED_WORDS = ["idiot", "moron", "stupid", "worthless", "pathetic", "disgusting", "scum", "loser", "trash", "clown", "imbecile", "dumb"]
EXCEPTIONS = ["trash can", "trash bin", "trash bag", "clown fish", "class clown", "circus clown", "pond scum", "scum line", "sore loser", "loser bracket"]
SEED_WEIGHT = 3.0
#: Bounds of the fit: labelled rows of each class, chosen by the hash of doc_id; entries of the lexicon.
SAMPLE_PER_CLASS = 6_000
MAX_ENTRIES = 2_000
#: An entry stands in at least so many toxic texts of the sample, and in this share of them, as groups of copies share rare words.
MIN_SUPPORT, MIN_SHARE = 3, 0.015
MIN_WEIGHT, SHORTEST, LONGEST = 2.0, 3, 12
THRESHOLD = 0.7


class _Fold(dict):
    """A translation table filled as characters turn up: letters fold, everything else is a space."""

    def __missing__(self, code: int):
        c = chr(code)
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms
            c = chr(code - 0xFEE0).lower()
        out = self.glyphs.get(c) or (c if c.isalpha() else " ")
        self[code] = out
        return out

    glyphs = {g: k for k, v in HOMOGLYPHS.items() for g in v} | DIGITS


_TABLE = _Fold()


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as Latin letters, all else as spaces, one space at either end."""
    text = text.lower()
    for sign, letter in SIGNS.items():
        if sign in text:
            parts = text.split(sign)
            for k in range(len(parts) - 1):  # a sign is a letter only between letters
                parts[k] += letter if parts[k][-1:].isalpha() and parts[k + 1][:1].isalpha() else " "
            text = "".join(parts)
    return f" {text.translate(_TABLE)} "


@dataclass
class Model:
    """weights: word beginning -> weight; bias and slopes of the two features."""

    weights: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEED_WORDS, SEED_WEIGHT))
    bias: float = -4.0
    slopes: tuple[float, float] = (1.5, 1.5)

    def score(self, raw: float, n_words: int) -> float:
        x = features(raw, n_words)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slopes[0] * x[0] + self.slopes[1] * x[1]))))


def features(raw: float, n_words: int) -> tuple[float, float]:
    """The weight found, and the weight for a hundred words, both on a log scale."""
    return math.log1p(raw), math.log1p(100 * raw / max(n_words, 1))


def matcher(weights: dict[str, float]):
    """folded text -> weight found. An entry counts where a word begins with it; the heaviest of a word counts; words inside
    an exception phrase don't. A word that is said again adds less each time."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for w, weight in weights.items():
        auto.add_word(f" {w}", (len(w), weight))
    for phrase in EXCEPTIONS:
        auto.add_word(f" {fold(phrase).strip()}", (len(fold(phrase).strip()), -1.0))
    auto.make_automaton()

    def found(folded: str) -> float:
        best: dict[int, float] = {}
        words: dict[str, tuple[float, int]] = {}
        safe: list[tuple[int, int]] = []
        for end, (n, weight) in auto.iter(folded):
            start = end - n
            if weight < 0:
                safe.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        reach = 0
        inside: list[tuple[int, int]] = []  # the phrases' places, each with the furthest end so far
        for a, b in sorted(safe):
            reach = max(reach, b)
            inside.append((a, reach))
        for at, weight in best.items():
            k = bisect_right(inside, (at, len(folded))) - 1
            if k < 0 or inside[k][1] < at:
                word = folded[at + 1 : folded.index(" ", at + 1)]
                words[word] = (weight, words.get(word, (0.0, 0))[1] + 1)
        return sum(weight * (1 + math.log(n)) for weight, n in words.values())

    return found


def _without_near_copies(texts: DataFrame) -> DataFrame:
    """One text of each class and smallest hash of a word triple: near copies mostly agree in it, and would pass a rare word for a frequent one."""
    words = F.split(F.lower("text"), f"{SPACE}+")
    split = texts.select("doc_id", "text", "toxic", words.alias("words"), F.greatest(F.size(words) - 2, F.lit(1)).alias("n"))
    triples = F.arrays_zip(F.slice("words", F.lit(1), F.col("n")).alias("a"), F.slice("words", F.lit(2), F.col("n")).alias("b"), F.slice("words", F.lit(3), F.col("n")).alias("c"))
    sketched = split.select("doc_id", "text", "toxic", F.array_min(F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"]))).alias("sketch"))
    return sketched.groupBy("toxic", "sketch").agg(F.min_by("text", "doc_id").alias("text")).select("text", "toxic")


def _beginnings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = set(fold(text).split())
            seen[toxic].update({w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)})
    names = list(seen[0].keys() | seen[1].keys())
    if names:
        yield pd.DataFrame({"entry": names, "toxic": [seen[1][x] for x in names], "clean": [seen[0][x] for x in names]})


def _chosen(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Drops an entry if a longer one covers nearly the same toxic texts, then one that a shorter one does as well for."""
    stats = {e: (t, math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))) for e, t, c in rows}
    longer: dict[str, int] = {}
    for e, (t, _) in stats.items():
        for k in range(SHORTEST, len(e)):
            longer[e[:k]] = max(longer.get(e[:k], 0), t)
    kept = {e: w for e, (t, w) in stats.items() if longer.get(e, 0) < 0.95 * t}
    return {e: w for e, w in kept.items() if not any(kept.get(e[:k], -99.0) > w - 0.7 for k in range(SHORTEST, len(e)))}


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, tuple[float, float]]:
    """Newton's method with a small ridge."""
    a, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + np.diag([1e-4, 0.02, 0.02]), a.T @ (y - p) - np.array([1e-4, 0.02, 0.02]) * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), (float(beta[1]), float(beta[2]))


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learns lexicon and calibration from (doc_id, toxic) labels.

    The fit reads at most sample_per_class labelled documents of each class (a documented bound, so the sample may be
    broadcast). A document labelled twice is toxic if one label says so. Null labels, ids and unknown ids
    are ignored. Without both classes the seed lexicon and fixed slopes are returned.
    """
    rows = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("doc_id")
    sample = rows.where("toxic = 1").orderBy(order, "doc_id").limit(sample_per_class).unionByName(rows.where("toxic = 0").orderBy(order, "doc_id").limit(sample_per_class))
    texts = materialize(_without_near_copies(docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")))  # read by three passes
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model()
    if not n.get(0) or not n.get(1):
        discard(texts)
        return model
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    found = texts.mapInPandas(_beginnings, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    top = found.where(F.col("toxic") >= max(MIN_SUPPORT, math.ceil(MIN_SHARE * n[1]))).where(odds >= MIN_WEIGHT).orderBy(F.desc("toxic"), "entry").limit(4 * MAX_ENTRIES).collect()
    learned = _chosen([tuple(r) for r in top], n[1], n[0])
    learned = dict(sorted(learned.items(), key=lambda kv: (-kv[1], kv[0]))[:MAX_ENTRIES])
    model.weights = {w: SEED_WEIGHT for w in SEED_WORDS if not any(w.startswith(e) or e.startswith(w) for e in learned)} | learned
    weights = model.weights

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = matcher(weights)
        for batch in batches:
            folded = [fold(t) for t in batch["text"]]
            x = [features(found(t), len(t.split())) for t in folded]
            yield pd.DataFrame({"a": [p for p, _ in x], "b": [q for _, q in x], "toxic": batch["toxic"]})

    fitted = texts.mapInPandas(measured, "a double, b double, toxic int").toPandas()  # two numbers for each row of the bounded sample
    discard(texts)
    model.bias, model.slopes = _logistic(fitted[["a", "b"]].to_numpy(), fitted["toxic"].to_numpy(dtype=float))
    return model


def scorer(model: Model):
    """A column function: text -> score from 0 to 1. Null and empty texts get the score of a text without any entry."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = matcher(model.weights)
        for texts in batches:
            out = []
            for t in texts:
                folded = fold(t or "")
                raw = found(folded)
                out.append(model.score(raw, len(folded.split()) if raw else 1))
            yield pd.Series(out, dtype="float64")

    return score


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row. Repeated rows come out as often as they come in; an empty table gives no rows;
    other columns are not read."""
    return docs.select("doc_id", scorer(model)(whole_text()).alias("score"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with its own columns, without the rows that score threshold or more. Null texts count as empty; repeated rows stay or go alike;
    an empty table gives no rows."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    scored = packed.select("row", scorer(model)(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("score"))
    return scored.where(F.col("score") < threshold).select("row.*")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that a fit may see: crc32 of the id as text, modulo 3, is not 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).select("doc_id", "toxic")
