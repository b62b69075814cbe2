"""Profiles of record lists: fields, tokens, ids, countries, missing combinations, truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ["entity_id", "business_name", "business_address", "country"]


def field_profile(records: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """A row for each field: rows, nulls, blanks, distinct values, and lengths (smallest, largest, mean, median, 95th percentile). Null counts as
    empty except in nulls. Fields are unpivoted, so one pass does."""
    long = records.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields])).alias("x")).select("x.field", "x.raw", F.coalesce("x.raw", F.lit("")).alias("v"))
    n = F.length("v")
    q = F.percentile(n, F.array(F.lit(0.5), F.lit(0.95)))
    return long.groupBy("field").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("raw").isNull().cast("long")).alias("null_count"), F.sum((F.trim("v") == "").cast("long")).alias("empty_or_blank"), F.countDistinct("v").alias("n_unique"),
        F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.avg(n).alias("mean_len"), q.alias("q"),
    ).select("field", "n", "null_count", "empty_or_blank", "n_unique", "min_len", "max_len", "mean_len", F.col("q")[0].alias("median_len"), F.col("q")[1].alias("p95_len"))


def token_profile(tokens: DataFrame) -> DataFrame:
    """One row from a column tokens: all tokens, mean and largest number, vocabulary."""
    sizes = tokens.agg(F.sum(F.size("tokens")).alias("total_tokens"), F.avg(F.size("tokens")).alias("mean_tokens"), F.max(F.size("tokens")).alias("max_tokens"))
    return sizes.join(token_counts(tokens).agg(F.count(F.lit(1)).alias("vocab_size")), F.lit(True))


def token_counts(tokens: DataFrame) -> DataFrame:
    return tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def top_tokens(tokens: DataFrame, k: int = 25, rare: bool = False) -> DataFrame:
    """The k most (or least) frequent tokens, ties by token: a top-k report."""
    return token_counts(tokens).orderBy(F.asc("n") if rare else F.desc("n"), "token").limit(k)


def id_profile(records: DataFrame) -> DataFrame:
    """(prefix, n, duplicate_ids) of ids; those without a hyphen are (none)."""
    prefix = F.when(F.col("entity_id").contains("-"), F.substring_index("entity_id", "-", 1)).otherwise("(none)")
    per_id = records.groupBy("entity_id").agg(F.count(F.lit(1)).alias("c"))
    return per_id.groupBy(prefix.alias("prefix")).agg(F.sum("c").alias("n"), F.sum(F.col("c") - 1).alias("duplicate_ids"))


def country_distribution(records: DataFrame, k: int = 30) -> DataFrame:
    """The k most frequent countries: a top-k report."""
    return records.groupBy("country").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "country").limit(k)


def missing_combinations(records: DataFrame) -> DataFrame:
    blank = lambda c: (F.trim(F.coalesce(c, F.lit(""))) == "").alias(f"{c.split('_')[-1]}_missing")
    return records.groupBy(blank("business_name"), blank("business_address"), blank("country")).agg(F.count(F.lit(1)).alias("n"))


def character_profile(records: DataFrame) -> DataFrame:
    """Rows whose name has other than ASCII characters, and rows with punctuation."""
    v = F.coalesce("business_name", F.lit(""))
    return records.agg(F.sum(v.rlike(r"[^\x00-\x7F]").cast("long")).alias("unicode_rows"), F.sum(v.rlike(r"[^\p{L}\p{N}\s]").cast("long")).alias("punctuation_rows"))


def address_numbers(addresses: DataFrame) -> DataFrame:
    """Digit runs in all, and rows with a postal-like one; columns numbers and postals."""
    return addresses.agg(F.sum(F.size("numbers")).alias("numeric_token_total"), F.sum((F.size("postals") > 0).cast("long")).alias("records_with_postal_like"))


def truth_profile(lists: DataFrame) -> DataFrame:
    """One row from (source1_entity_id, ids): rows, unique ids, duplicates, singletons, multi-matches and matches by source."""
    n = F.size("ids")
    of = lambda p: F.sum(F.size(F.filter("ids", lambda x: x.startswith(p))))
    return lists.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source1_entity_id").alias("n_unique_s1"), (F.count(F.lit(1)) - F.countDistinct("source1_entity_id")).alias("duplicate_s1_rows"),
        F.sum((n == 0).cast("long")).alias("n_singletons"), F.sum((n >= 2).cast("long")).alias("n_multi_match_entities"), F.sum(n).alias("positive_match_ids_total"), of("S2-").alias("s2_positive_count"), of("S3-").alias("s3_positive_count"),
    )


def match_count_distribution(lists: DataFrame) -> DataFrame:
    return lists.groupBy(F.size("ids").alias("matches")).agg(F.count(F.lit(1)).alias("n"))
