"""The richer text views: folding, multi-word forms, tokens, character grams, postal candidates, countries.

Folding needs Unicode tables that Spark lacks, so texts with other than ASCII characters pass a batch function; everything after it,
and ASCII texts as a whole, are Catalyst expressions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Punctuation with a plain form.
PLAIN = {
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "−": "-", " ": " ",
    "​": "", "﻿": "", "…": "...",
}
# Signs read as words, in this order.
SIGNS = [(r"\s*&\s*", " and "), (r"\s*\+\s*", " and "), (r"\s+@\s+", " at ")]
# Legal and business forms that a core name lacks.
LEGAL_TOKENS = [
    "incorporated", "inc", "corporation", "corp", "corporate", "company", "co", "limited", "ltd", "llc", "llp", "lp", "plc", "private", "pvt", "pvtltd", "pte", "srl", "gmbh", "sa",
    "ag", "bv", "nv", "sas", "sarl", "spa", "kk", "oy", "ab", "as", "pty", "trust", "foundation", "enterprises", "enterprise", "international", "intl", "group", "holdings", "holding", "ltda",
]
# Forms of several words, applied in this order before single words.
PHRASES = [
    (r"\bprivate\s+limited\b", "pvt ltd"), (r"\bpvt\.?\s*ltd\.?\b", "pvt ltd"), (r"\bpvt\b(?!\s*ltd)", "pvt ltd"), (r"\bsociete\s+anonyme\b", "sa"), (r"\bco\s+limited\b", "co ltd"),
    (r"\bsociedade\s+anonima\b", "sa"), (r"\bgesellschaft\s+m\.?\s*b\.?\s*h\.?\b", "gmbh"),
]
# Short forms of name words and of address words, and names of countries.
NAME_WORDS = {"incorporated": "inc", "corporation": "corp", "corporate": "corp", "company": "co", "limited": "ltd", "private": "pvt", "international": "intl", "holdings": "holding", "enterprises": "enterprise"}
ADDRESS_WORDS = {
    "road": "rd", "street": "st", "avenue": "ave", "avenu": "ave", "boulevard": "blvd", "drive": "dr", "lane": "ln", "highway": "hwy", "parkway": "pkwy", "place": "pl", "court": "ct", "circle": "cir",
    "square": "sq", "terrace": "ter", "floor": "flr", "building": "bldg", "apartment": "apt", "suite": "ste", "number": "no", "opposite": "opp", "post": "po", "district": "dist", "north": "n", "south": "s",
    "east": "e", "west": "w", "northern": "n", "southern": "s", "eastern": "e", "western": "w", "chemin": "chem", "route": "rte", "impasse": "imp",
}
COUNTRIES = {
    "us": "united states", "usa": "united states", "u s a": "united states", "u s": "united states", "united states of america": "united states", "america": "united states", "in": "india", "ind": "india",
    "bharat": "india", "fr": "france", "fra": "france", "french republic": "france", "uk": "united kingdom", "gb": "united kingdom", "great britain": "united kingdom", "uae": "united arab emirates",
    "ca": "canada", "cn": "china", "de": "germany", "au": "australia", "sg": "singapore", "ae": "united arab emirates", "jp": "japan", "kr": "korea", "br": "brazil", "mx": "mexico", "nl": "netherlands",
    "it": "italy", "es": "spain", "ch": "switzerland",
}
STOP_WORDS = ["the", "of", "and", "at", "for", "to", "in", "a", "an", "on"]
GRAM, MOST_GRAMS = 4, 40


def fold_text(text: str | None) -> str:
    """Plain punctuation, compatibility composition, marks stripped, case folded."""
    out = unicodedata.normalize("NFKC", (text or "").translate(str.maketrans(PLAIN)))
    return "".join(c for c in unicodedata.normalize("NFKD", out) if not unicodedata.combining(c)).casefold()


@F.pandas_udf(T.StringType())
def _folded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: None if t is None else fold_text(t))


def fold(text: Column) -> Column:
    """Only rows with other characters carry text into the batch function."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = ~text.rlike(r"[^\x00-\x7F]")
    return F.when(plain, F.lower(text)).otherwise(_folded(F.when(~plain, text)))


def clean_folded(folded: Column) -> Column:
    out = folded
    for pattern, word in SIGNS:
        out = F.regexp_replace(out, pattern, word)
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _mapped(tokens: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.transform(tokens, lambda t: F.coalesce(F.element_at(pairs, t), t))


def heavy_name(clean: Column) -> Column:
    out = clean
    for pattern, form in PHRASES:
        out = F.regexp_replace(out, pattern, form)
    return F.array_join(_mapped(words(out), NAME_WORDS), " ")


def core_tokens(heavy: Column) -> Column:
    """Without legal words; a word that repeats its predecessor goes."""
    kept = F.filter(words(heavy), lambda w: ~w.isin(LEGAL_TOKENS))
    paired = F.arrays_zip(kept.alias("w"), F.concat(F.array(F.lit("")), kept).alias("before"))
    return F.transform(F.filter(paired, lambda p: p["w"].isNotNull() & (p["w"] != p["before"])), lambda p: p["w"])


def grams(text: Column, n: int = GRAM, most: int = MOST_GRAMS) -> Column:
    """Distinct character n-grams of a text without spaces, in order; of more than `most` every (count / most)-th; a short text is its own gram."""
    s = F.replace(text, F.lit(" "), F.lit(""))
    count = F.length(s) - (n - 1)
    start = lambda i: F.when(count > most, F.floor(i * (count / most)).cast("int")).otherwise(i)
    places = F.sequence(F.lit(0), F.least(count, F.lit(most)) - 1)
    long = F.array_distinct(F.transform(places, lambda i: s.substr(start(i) + 1, F.lit(n))))
    return F.when(count > 0, long).when(s != "", F.array(s)).otherwise(F.array().cast("array<string>"))


def heavy_address(clean: Column) -> Column:
    """Short forms of address words; numbers without leading zeros. Repeated words stay."""
    short = _mapped(words(clean), ADDRESS_WORDS)
    return F.array_join(F.transform(short, lambda t: F.when(t.rlike("^[0-9]+$"), F.regexp_replace(t, "^0+(?=.)", "")).otherwise(t)), " ")


def numbers(raw: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(raw.cast("string"), F.lit("")), F.lit("([0-9]+)"), F.lit(1))


def alnum_tokens(folded: Column) -> Column:
    return F.regexp_extract_all(folded, F.lit("([a-z0-9]+)"), F.lit(1))


def postal_candidates(raw: Column) -> Column:
    """Digit runs of 5 or 6; ZIP+4 forms; the first six digits of runs of 7 to 9; distinct, in that order."""
    runs = numbers(raw)
    five = F.filter(runs, lambda r: F.length(r).between(5, 6))
    zip4 = F.regexp_extract_all(F.coalesce(raw.cast("string"), F.lit("")), F.lit(r"(?<![0-9A-Za-z_])([0-9]{5,6}(?:[- ][0-9]{3,4})?)(?![0-9A-Za-z_])"), F.lit(1))
    weak = F.transform(F.filter(runs, lambda r: F.length(r).between(7, 9)), lambda r: F.substring(r, 1, 6))
    return F.array_distinct(F.concat(five, zip4, weak))


def house_number(raw: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.coalesce(raw.cast("string"), F.lit("")), "([0-9]+)", 1), "^0+(?=.)", "")


def canonical_country(clean: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    return F.coalesce(F.element_at(table, clean), clean)


def prepare(records: DataFrame) -> DataFrame:
    """entity_id and what other columns there are, with all rich views."""
    keep = [c for c in records.columns if c not in ("business_name", "business_address", "country")]
    raw = records.select(*keep, F.col("business_name").alias("raw_name"), F.col("business_address").alias("raw_addr"), F.col("country").alias("raw_country"))
    folded = raw.select("*", fold(F.col("raw_name")).alias("fold_name"), fold(F.col("raw_addr")).alias("fold_addr"), fold(F.col("raw_country")).alias("fold_country"))
    clean = folded.select("*", clean_folded(F.col("fold_name")).alias("name"), clean_folded(F.col("fold_addr")).alias("addr"), clean_folded(F.col("fold_country")).alias("clean_country"))
    heavy = clean.select("*", heavy_name(F.col("name")).alias("name_heavy"), heavy_address(F.col("addr")).alias("addr_heavy"), canonical_country(F.col("clean_country")).alias("country"))
    tokens = heavy.select("*", core_tokens(F.col("name_heavy")).alias("core_tokens"), words(F.col("name")).alias("name_tokens"), words(F.col("addr")).alias("addr_tokens"))
    return tokens.select(
        "*", F.array_join("core_tokens", " ").alias("name_core"), grams(F.col("name_heavy")).alias("name_grams"), grams(F.col("addr_heavy")).alias("addr_grams"),
        postal_candidates(F.col("raw_addr")).alias("postals"), house_number(F.col("raw_addr")).alias("house"), alnum_tokens(F.col("fold_addr")).alias("addr_alnum"), (F.col("clean_country") != "").alias("country_present"),
    )


def drop_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(STOP_WORDS))


def match_list(raw: Column, semicolons: bool = True) -> Column:
    """Ids of a match list: null, empty, nan, none and null give none; commas (and semicolons) part; distinct, in order."""
    text = F.trim(F.coalesce(raw.cast("string"), F.lit("")))
    parts = F.split(F.replace(text, F.lit(";"), F.lit(",")) if semicolons else text, ",")
    ids = F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))
    return F.when(F.lower(text).isin("", "nan", "none", "null"), F.array().cast("array<string>")).otherwise(ids)
