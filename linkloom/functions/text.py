"""Text views of a record as Catalyst expressions: no Python runs for any of them."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole words that shorten in a name, and legal forms that a core name lacks.
HEAVY = {"incorporated": "inc", "corporation": "corp", "limited": "ltd"}
LEGAL = ["ltd", "limited", "llc", "inc", "corp", "corporation", "company", "co", "pvt", "private", "plc", "llp"]


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Composed characters and the base character of their canonical decomposition without marks. Hangul stays composed."""
    source, target = [], []
    for code in [*range(0x80, 0x3000), *range(0xF900, 0xFB00)]:
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x)[0] != "M")
        if base != c and len(base) == 1:
            source.append(c)
            target.append(base)
    return "".join(source), "".join(target)


def strip_accents(text: Column) -> Column:
    source, target = accent_table()
    return F.regexp_replace(F.translate(text, source, target), r"\p{M}", "")


def word(pattern: str) -> str:
    """Word limits in the ASCII sense: Java's own are Unicode-aware."""
    return f"(?<![0-9A-Za-z_])(?:{pattern})(?![0-9A-Za-z_])"


def name(text: Column) -> Column:
    """Accents stripped, lower case, runs of anything but letters and digits as one space; not trimmed. Null is empty.

    A text of as many bytes as characters has no accents, and its letters are known; it skips the table and Unicode's classes.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")).otherwise(F.regexp_replace(F.lower(strip_accents(text)), r"[^\p{L}\p{N}]+", " "))


def heavy_of(named: Column) -> Column:
    """The heavy view of a column of name(). The words are looked for by their bytes before their limits are."""
    out, some = named, F.lit(False)
    for long, short in HEAVY.items():
        out, some = F.regexp_replace(out, word(long), short), some | F.contains(named, F.lit(long))
    return F.trim(F.when(some, out).otherwise(named))


def core_of(heavy: Column) -> Column:
    """Without legal forms; spaces that stood around one inside the name stay."""
    return F.trim(F.regexp_replace(heavy, word("|".join(LEGAL)), " "))


def name_heavy(text: Column) -> Column:
    return heavy_of(name(text))


def name_core(text: Column) -> Column:
    return core_of(name_heavy(text))


def address(text: Column) -> Column:
    return F.trim(F.regexp_replace(name(text), word("road|rd"), "rd"))


def country(text: Column) -> Column:
    return F.lower(F.trim(F.coalesce(text.cast("string"), F.lit(""))))


def house(addr: Column) -> Column:
    """The first one to six digits of a normalised address, empty if none."""
    return F.regexp_extract(addr, "([0-9]{1,6})", 1)


def postal(addr: Column) -> Column:
    """The first number of five or six digits that stands alone, empty if none."""
    return F.regexp_extract(addr, word("([0-9]{5,6})"), 1)


def prepare(records: DataFrame) -> DataFrame:
    """Adds the text views to entity_id, business_name, business_address, country; the raw columns stay as raw_*.

    Nulls and blanks end up empty, so later joins need no null-safe equality. Each view is a select over the one before, so none is computed twice.
    """
    keep = [c for c in records.columns if c not in ("business_name", "business_address", "country")]
    raw = records.select(*keep, F.col("business_name").alias("raw_name"), F.col("business_address").alias("raw_addr"), F.col("country").alias("raw_country"))
    named = raw.select("*", name(F.col("raw_name")).alias("name"), address(F.col("raw_addr")).alias("addr"), country(F.col("raw_country")).alias("country"))
    heavy = named.select("*", heavy_of(F.col("name")).alias("name_heavy"))
    views = heavy.select(*keep, "raw_name", "raw_addr", "raw_country", "name", "name_heavy", core_of(F.col("name_heavy")).alias("name_core"), "addr", "country")
    return views.select("*", F.substring("name_core", 1, 3).alias("name_prefix"), F.substring("addr", 1, 4).alias("addr_prefix"), house(F.col("addr")).alias("house"), postal(F.col("addr")).alias("postal"))


def duck_name(c: str) -> str:
    return f"regexp_replace(lower(strip_accents(coalesce({c}, ''))), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"


def duck_heavy(c: str) -> str:
    out = duck_name(c)
    for long, short in HEAVY.items():
        out = f"regexp_replace({out}, '\\b{long}\\b', '{short}', 'g')"
    return f"trim({out})"


def duck_core(c: str) -> str:
    return f"trim(regexp_replace({duck_heavy(c)}, '\\b({'|'.join(LEGAL)})\\b', ' ', 'g'))"


def duck_address(c: str) -> str:
    return f"trim(regexp_replace({duck_name(c)}, '\\b(road|rd)\\b', 'rd', 'g'))"


def duck_prepare(relation: str, keep: str) -> str:
    """The SQL that prepare() corresponds to, for DuckDB."""
    return f"""
      select *, left(name_core, 3) as name_prefix, left(addr, 4) as addr_prefix, regexp_extract(addr, '([0-9]{{1,6}})', 1) as house, regexp_extract(addr, '\\b([0-9]{{5,6}})\\b', 1) as postal
      from (select {keep}, business_name as raw_name, business_address as raw_addr, country as raw_country, {duck_name('business_name')} as name, {duck_heavy('business_name')} as name_heavy,
        {duck_core('business_name')} as name_core, {duck_address('business_address')} as addr, lower(trim(coalesce(country, ''))) as country from {relation})
    """
