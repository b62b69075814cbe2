"""Retrieval by shared tokens, character grams, postal codes and exact views: the richer blocks.

Terms over a posting cap are taken out. Frequent terms (grams, tokens) are counted between classes of equal records in overlap.py, rare ones meet in an
equi-join of both sides' exploded terms. A window keeps the best few for each clean record, a feature of the blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import ratios
from .overlap import classes, expanded, once, shared_terms

# The blocks' bits, then caps and limits of the blocks.
BITS = {
    "exact_name": 1, "core_name": 2, "exact_address": 4, "name_housenumber": 8, "postal_name": 16, "rare_name_token": 32, "rare_addr_token": 64, "char_ngram": 128, "token_overlap": 256,
    "country_approx": 512, "addr_ngram": 1024, "exact_name_heavy": 2048,
}
TOP, RARE, SHORTEST = 200, 400, 3
TOKEN_POSTINGS, GRAM_POSTINGS, POSTAL_POSTINGS, COUNTRY_ROWS = 20_000, 8_000, 20_000, 200_000
POSTAL_LEAST, COUNTRY_LEAST, MISSING_NAME = 0.5, 0.60, 0.4
NO_RANK = 10**9


def document_frequency(records: DataFrame, column: str) -> DataFrame:
    """(term, df): records that hold a token (array column) or have a value (string column); empty ones don't count."""
    term = F.explode(F.array_distinct(column)) if dict(records.dtypes)[column].startswith("array") else F.col(column)
    return records.select(term.alias("term")).where(F.col("term") != "").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf(frequency: DataFrame, total: int) -> DataFrame:
    """(term, df, idf), idf = ln((1 + total) / (1 + df)) + 1."""
    return frequency.withColumn("idf", F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("df"))) + 1)


def non_empty(records: DataFrame, column: str) -> int:
    return records.where(F.col(column) != "").count() or 1


def postings(pool: DataFrame, column: str, cap: int) -> DataFrame:
    """(term, gid, country) of terms that at most cap candidates hold."""
    rows = pool.select(F.explode(F.array_distinct(column)).alias("term"), F.col("entity_id").alias("gid"), F.col("source")).where(F.col("term") != "")
    kept = rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= cap).select("term")
    return rows.join(kept, "term")


def best(pairs: DataFrame, weight: str, top: int = TOP) -> DataFrame:
    """The heaviest pairs of each clean record, ties by id, with rank from 0. The limit stands on the row number itself, so that each task cuts its pairs before they are shuffled."""
    order = Window.partitionBy("rid").orderBy(F.desc(weight), "gid")
    return pairs.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= top).withColumn("rank", F.col("rn") - 1).drop("rn")


def exact(s1: DataFrame, pool: DataFrame, columns: list[str], same_country: bool, cap: int = TOP) -> DataFrame:
    """(rid, gid, source) of equal, non-empty views. A value's candidates are cut to the first cap by id before the country test."""
    some = F.least(*[F.length(c) for c in columns], F.lit(1 << 30)) > 0
    order = Window.partitionBy(*columns).orderBy("entity_id")
    right = pool.where(some).withColumn("k", F.row_number().over(order)).where(F.col("k") <= cap).select(*columns, F.col("entity_id").alias("gid"), "source", F.col("country").alias("c_country"))
    left = s1.where(some).select(*columns, F.col("entity_id").alias("rid"), F.col("country").alias("s_country"))
    pairs = left.join(right, columns)
    if same_country:
        pairs = pairs.where((F.col("s_country") == "") | (F.col("s_country") == F.col("c_country")))
    return pairs.select("rid", "gid", "source")


def rare_token(s1: DataFrame, pool: DataFrame, frequency: DataFrame, column: str, index_column: str, digits: bool, top: int = TOP) -> DataFrame:
    """(rid, gid, source, weight, rank): the sum of idf over shared rare tokens of three characters or more."""
    rare = frequency.where((F.length("term") >= SHORTEST) & (F.col("df") <= RARE))
    if not digits:
        rare = rare.where(~F.col("term").rlike("^[0-9]+$"))
    left = s1.select(F.col("entity_id").alias("rid"), F.explode(F.array_distinct(column)).alias("term")).join(rare, "term")
    shared = left.join(postings(pool, index_column, TOKEN_POSTINGS), "term").groupBy("rid", "gid", "source").agg(F.sum("idf").alias("weight"))
    return best(shared.withColumn("weight", F.round("weight", 9)), "weight", top)


def _by_terms(s1: DataFrame, pool: DataFrame, mine: list[str], theirs: list[str], terms: Column, their_terms: Column, cap: int, least: int, top: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of clean records (columns mine, l), of candidates (theirs, r), and (l, r, shared) of classes that share at least `least` terms."""
    left, right = classes(s1, mine, "l"), classes(pool, theirs, "r")
    return left, right, shared_terms(left.select("l", terms.alias("terms")), right.select("r", "n", their_terms.alias("terms")), cap, least, top)


def _members(s1: DataFrame, pool: DataFrame, left: DataFrame, right: DataFrame, mine: list[str], theirs: list[str], *more: str) -> tuple[DataFrame, DataFrame]:
    """(rid, l) and (gid, source, r) of the records of classes, with more of their columns."""
    clean = s1.join(left.drop("n"), mine).select("l", F.col("entity_id").alias("rid"), *more)
    return clean, pool.join(right.drop("n"), theirs).select("r", F.col("entity_id").alias("gid"), "source", *more)


def gram_overlap(s1: DataFrame, pool: DataFrame, column: str, top: int = TOP) -> DataFrame:
    """(rid, gid, source, shared, rank, jaccard): at least two shared grams; jaccard is shared over the clean record's grams. Records of equal grams meet once."""
    left, right, pairs = _by_terms(s1, pool, [column], [column], F.col(column), F.col(column), GRAM_POSTINGS, 2, top)
    sizes = left.select("l", F.size(column).alias("n"))
    clean, members = _members(s1, pool, left, right, [column], [column])
    best_ones = expanded(pairs.join(sizes, "l"), F.col("shared"), clean, members, ["l"], ["r"], top)
    return best_ones.select("rid", "gid", "source", "shared", "rank", (F.col("shared") / F.greatest("n", F.lit(1))).alias("jaccard"))


def _long_terms(column: str) -> Column:
    return F.filter(F.array_distinct(column), lambda t: F.length(t) >= SHORTEST)


def token_overlap(s1: DataFrame, pool: DataFrame, top: int = TOP) -> DataFrame:
    """(rid, gid, source, overlap, rank): shared core tokens of three characters or more over all of the clean record's distinct core tokens. Records of equal tokens meet once."""
    left, right, pairs = _by_terms(s1, pool, ["core_tokens"], ["name_tokens"], _long_terms("core_tokens"), F.array_distinct("name_tokens"), TOKEN_POSTINGS, 1, top)
    sizes = left.select("l", F.size(F.array_distinct("core_tokens")).alias("n"))
    clean, members = _members(s1, pool, left, right, ["core_tokens"], ["name_tokens"])
    best_ones = expanded(pairs.join(sizes, "l"), F.col("shared"), clean, members, ["l"], ["r"], top)
    return best_ones.select("rid", "gid", "source", (F.col("shared") / F.col("n")).alias("overlap"), "rank")


def postal_name(s1: DataFrame, pool: DataFrame, top: int = TOP) -> DataFrame:
    """(rid, gid, source): a shared postal code and alike names, the best for each code; a missing name on either side counts as MISSING_NAME and passes.
    Records of equal code and name meet once, names are compared once."""
    left = s1.select(F.col("entity_id").alias("rid"), F.col("name").alias("mine"), F.explode("postals").alias("term"))
    names = pool.select(F.col("entity_id").alias("gid"), F.col("name").alias("theirs"))
    right = postings(pool, "postals", POSTAL_POSTINGS).join(names, "gid")
    pairs = left.select("term", "mine").distinct().join(right.select("term", "theirs").distinct(), "term")
    both = (F.col("mine") != "") & (F.col("theirs") != "")
    sim = F.when(both, ratios(F.when(both, F.col("mine")), F.when(both, F.col("theirs")), "token_set_ratio")["token_set_ratio"]).otherwise(F.lit(MISSING_NAME))
    scored = once(pairs, ["mine", "theirs"], sim=sim).where(~both | (F.col("sim") >= POSTAL_LEAST))
    return expanded(scored, F.col("sim"), left, right, ["term", "mine"], ["term", "theirs"], top).select("rid", "gid", "source").distinct()


def country_approx(s1: DataFrame, pool: DataFrame, top: int = TOP) -> DataFrame:
    """(rid, gid, source): of the same country, sharing a core token or a gram, with token sets alike; countries over COUNTRY_ROWS candidates are left out.

    Names meet once, whatever records hold them; countries are compared when the records come back.
    """
    mine, theirs = ["name", "name_grams", "core_tokens"], ["name", "name_grams", "name_tokens"]
    some = s1.where("name <> ''")
    left, right, grams = _by_terms(some, pool, mine, theirs, F.col("name_grams"), F.col("name_grams"), GRAM_POSTINGS, 1, None)
    _, _, tokens = _by_terms(some, pool, mine, theirs, _long_terms("core_tokens"), F.array_distinct("name_tokens"), TOKEN_POSTINGS, 1, None)
    near = grams.union(tokens).select("l", "r").distinct()
    pairs = near.join(left.select("l", F.col("name").alias("mine")), "l").join(right.select("r", F.col("name").alias("theirs")), "r")
    alike = pairs.withColumn("sim", ratios(F.col("mine"), F.col("theirs"), "token_set_ratio")["token_set_ratio"]).where(F.col("sim") >= COUNTRY_LEAST).select("l", "r", "sim")
    small = pool.groupBy("country").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= COUNTRY_ROWS).select("country")
    clean, members = _members(some, pool, left, right, mine, theirs, "country")
    there = alike.join(clean.select("l", "country").distinct().join(small, "country"), "l")
    return expanded(there, F.col("sim"), clean, members, ["l", "country"], ["r", "country"], top).select("rid", "gid", "source")


def idf_overlap(pairs: DataFrame, s1: DataFrame, pool: DataFrame, name_idf: DataFrame) -> DataFrame:
    """Adds the sum of idf over core tokens that both records have; a token without a frequency counts 1. Summed once for records of equal tokens."""
    terms = lambda df, key: df.select(F.col("entity_id").alias(key), F.array_distinct("core_tokens").alias(f"{key}_terms"))
    both = pairs.join(terms(s1, "rid"), "rid").join(terms(pool, "gid"), "gid")
    shared = both.select("rid_terms", "gid_terms").distinct().withColumn("term", F.explode(F.array_intersect("rid_terms", "gid_terms")))
    sums = shared.join(name_idf.select("term", "idf"), "term", "left").groupBy("rid_terms", "gid_terms").agg(F.sum(F.coalesce("idf", F.lit(1.0))).alias("idf_overlap"))
    return both.join(sums, ["rid_terms", "gid_terms"], "left").withColumn("idf_overlap", F.coalesce("idf_overlap", F.lit(0.0))).select(*pairs.columns, "idf_overlap")


def rich_candidates(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """All twelve blocks merged: rid, gid, source, blocks (mask), n_blocks, three ranks, token_overlap, ngram_jaccard, idf_overlap."""
    merged, names = merged_blocks(s1, pool, list(BITS))
    return idf_overlap(merged, s1, pool, names)


def merged_blocks(s1: DataFrame, pool: DataFrame, wanted: list[str]) -> tuple[DataFrame, DataFrame]:
    """The pairs of the wanted blocks with what the blocks say of them, and the idf of name tokens."""
    names = idf(document_frequency(pool.unionByName(s1.withColumn("source", F.lit("S1")), allowMissingColumns=True), "name_tokens"), non_empty(pool, "name") + non_empty(s1, "name"))
    addresses = idf(document_frequency(pool.unionByName(s1.withColumn("source", F.lit("S1")), allowMissingColumns=True), "addr_tokens"), non_empty(pool, "addr") + non_empty(s1, "addr"))
    blank = {"name_rank": F.lit(NO_RANK), "ngram_rank": F.lit(NO_RANK), "addr_rank": F.lit(NO_RANK), "token_overlap": F.lit(0.0), "ngram_jaccard": F.lit(0.0)}

    def block(name: str, pairs: Callable[[], DataFrame], **own) -> DataFrame | None:
        return None if name not in wanted else pairs().select("rid", "gid", "source", F.lit(BITS[name]).alias("bit"), *[(own.get(c, v)).alias(c) for c, v in blank.items()])

    parts = [
        block("exact_name", lambda: exact(s1, pool, ["name"], True)), block("exact_name_heavy", lambda: exact(s1, pool, ["name_heavy"], True)), block("core_name", lambda: exact(s1, pool, ["name_core"], True)),
        block("exact_address", lambda: exact(s1, pool, ["addr"], False)), block("name_housenumber", lambda: exact(s1, pool, ["name", "house"], False)), block("postal_name", lambda: postal_name(s1, pool)),
        block("rare_name_token", lambda: rare_token(s1, pool, names, "core_tokens", "name_tokens", True)), block("rare_addr_token", lambda: rare_token(s1, pool, addresses, "addr_tokens", "addr_tokens", False)),
        block("char_ngram", lambda: gram_overlap(s1, pool, "name_grams"), ngram_rank=F.col("rank"), ngram_jaccard=F.col("jaccard")), block("addr_ngram", lambda: gram_overlap(s1, pool, "addr_grams"), addr_rank=F.col("rank")),
        block("token_overlap", lambda: token_overlap(s1, pool), name_rank=F.col("rank"), token_overlap=F.col("overlap")), block("country_approx", lambda: country_approx(s1, pool)),
    ]
    parts = [p for p in parts if p is not None]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("rid", "gid", "source").agg(
        F.expr("bit_or(bit)").alias("blocks"), F.min("name_rank").alias("name_rank"), F.min("ngram_rank").alias("ngram_rank"), F.min("addr_rank").alias("addr_rank"),
        F.max("token_overlap").alias("token_overlap"), F.max("ngram_jaccard").alias("ngram_jaccard"),
    )
    return merged.withColumn("n_blocks", F.bit_count("blocks")), names
