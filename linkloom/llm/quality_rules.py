"""Quality rules: lines are judged first, failing lines are taken out, then documents that lost too much are rejected.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, whole_text

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document is rejected if its failing lines hold more than this part of its characters.
MAX_LOST_PERCENT = 50
#: A line fails for punctuation with more symbols or exclamation marks than this part of its words.
MAX_SYMBOL_PERCENT = 30
#: A line with so many menu separators, more than MENU_PERCENT of its words, is navigation.
MENU_MARKS, MENU_PERCENT = 3, 20
#: Phrases of page furniture, lower case, and how a line that is cut off ends.
BOILERPLATE = [
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service", "terms of use", "click here", "sign in", "log in", "subscribe to our", "enable javascript", "back to top", "skip to content", "share this page",
    "alle rechte vorbehalten", "cookies akzeptieren", "nach oben", "todos los derechos reservados", "aceptar cookies", "aviso legal", "tous droits", "accepter les cookies", "retour en haut",
]
CUT_OFF = ["...", "…"]


def count_of(text: Column, characters: str) -> Column:
    """Occurrences of single characters. One byte scan each; a regular expression would build strings."""
    left = text
    for c in characters:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.length(text) - F.length(left)


def line_fails(line: Column, lower: Column) -> Column:
    """The rules on one line and its lower-case form; one without a word passes. Symbols and exclamation marks are counted against the spaces plus one.

    Punctuation: too many symbols, or an end that is cut off. Navigation: menu separators. Boilerplate: phrases, each a scan for its bytes.
    """
    furniture = F.lit(False)
    for phrase in BOILERPLATE:
        furniture = furniture | F.contains(lower, F.lit(phrase))
    for mark in CUT_OFF:
        furniture = furniture | F.endswith(F.rtrim(line), F.lit(mark))
    words = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    symbols, menu = count_of(line, SYMBOLS + "!"), count_of(line, "|>»•")
    return (symbols * 100 > words * MAX_SYMBOL_PERCENT) | ((menu >= MENU_MARKS) & (menu * 100 > words * MENU_PERCENT)) | furniture


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more, the first included.

    The windows' hashes are sorted once with their places; a window is repeated if a neighbour has its hash. Each
    repeated window then adds what it covers up to the next one. No lambda looks into another array, so the work is n log n.
    """
    n = F.greatest(F.size(words) - 2, F.lit(0))
    at = lambda arr, start, length: F.slice(arr, start, length)
    hashes = F.transform(F.arrays_zip(at(words, F.lit(1), n), at(words, F.lit(2), n), at(words, F.lit(3), n)), lambda w: F.xxhash64(w["0"], w["1"], w["2"]))
    return F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))


def without_breaks(text: str) -> Column:
    return F.replace(F.col(text), F.lit("\n"), F.lit(""))


def quality_flags(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    lost_percent, cleaned.

    cleaned is the text without its failing lines; lines without a word stay, and so does the order. What was lost and whether
    the document is kept follow from it.

    Null texts count as empty: all counts 0, base_failed. Repeated rows come out as often as they come in; an empty table
    gives no rows; other columns are not read. kept is false if base_failed or if failing lines hold more than half of the
    characters of all lines that have a word.
    """
    text = docs.select("doc_id", whole_text().alias("text"))
    split = text.select("doc_id", "text", F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    tagged = split.select(
        "doc_id", F.size("words").alias("n_words"), (F.length("text") - count_of(F.col("text"), " \t\n\x0b\x0c\r")).alias("word_chars"), count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), F.sort_array(repeated_words(F.col("words"))).alias("windows"),
        F.aggregate(F.transform("lines", lambda x: F.length(x)), F.lit(0), lambda a, x: a + x).alias("line_chars"),
        F.length(without_breaks("text")).alias("all_chars"), F.array_join(F.zip_with(F.split("text", "\n"), F.split(F.lower("text"), "\n"), lambda x, y: F.when(~line_fails(x, y), x)), "\n").alias("cleaned"),
    )
    size = F.size("windows")
    hashes = F.transform("windows", lambda x: x["h"])
    none = F.array(F.lit(None).cast("long"))
    around = tagged.select("*", F.arrays_zip(F.col("windows").alias("w"), F.slice(F.concat(none, hashes), F.lit(1), size).alias("before"), F.concat(F.slice(hashes, F.lit(2), F.greatest(size - 1, F.lit(0))), none).alias("after")).alias("zipped"))
    places = around.select("*", F.sort_array(F.transform(F.filter("zipped", lambda x: (x["w"]["h"] == x["before"]) | (x["w"]["h"] == x["after"])), lambda x: x["w"]["i"])).alias("at"))
    steps = F.zip_with("at", F.slice("at", F.lit(2), F.size("at")), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    counted = places.select("*", (F.col("all_chars") - F.length(without_breaks("cleaned"))).alias("lost"), F.aggregate(steps, F.lit(0), lambda a, x: a + x).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lost = F.when(F.col("line_chars") > 0, 100.0 * F.col("lost") / F.col("line_chars")).otherwise(F.lit(0.0))
    long = lambda c: F.col(c).cast("long").alias(c)
    return counted.select("doc_id", *map(long, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]), failed.alias("base_failed"), (~failed & (lost <= MAX_LOST_PERCENT)).alias("kept"), lost.alias("lost_percent"), "cleaned")
