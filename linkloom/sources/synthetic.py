"""Synthetic record lists with truth, computed from row numbers: the same for any number of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Own vocabulary.
FIRST = ["amber", "basalt", "cobalt", "dune", "elm", "flint", "garnet", "harbor", "indigo", "jasper", "kelp", "lotus", "maple", "nimbus", "opal", "pine"]
SECOND = ["foods", "motors", "textiles", "optics", "tools", "marine", "paper", "energy", "media", "glass", "steel", "seeds"]
FORMS = ["Limited", "Private Limited", "Incorporated", "Corporation", "LLC", "Company"]
STREETS = ["Oak Road", "Mill Street", "Lake Avenue", "Hill Lane", "Station Road", "Park Street"]
COUNTRIES = ["United States", "India"]
TEST_COUNTRY = "France"
SINGLETONS, ONE_DRAW = 30, 75  # percent of records without a match, and up to one draw; the rest have two to three


def _pick(words: list[str], *salt) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64(*salt), F.lit(len(words))) + 1).cast("int"))


def _chance(*salt) -> Column:
    return F.pmod(F.xxhash64(*salt), F.lit(100))


def _edited(name: Column, kind: Column) -> Column:
    """Nine edits of a name."""
    words = F.split(name, " ")
    swapped = F.array_join(F.concat(F.slice(words, 2, 1), F.slice(words, 1, 1), F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0)))), " ")
    edits = [F.lower(name), F.upper(name), F.replace(name, F.lit(" "), F.lit("-")), F.regexp_replace(name, "Limited", "Ltd."), F.regexp_replace(name, " [A-Za-z]+$", ""), swapped, F.expr("left(name, length(name) - 2)"), F.concat(words[0], F.lit(" "), name), F.regexp_replace(name, " and ", " & ")]
    return F.coalesce(*[F.when(kind == k, e) for k, e in enumerate(edits)], name)


def synthetic(spark: SparkSession, n: int, seed: int = 13, test: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(s1, candidates, truth): 30 % of the clean records without a match, 45 % with one draw, 25 % with two or three; a draw copies a record with one edit
    to S2 or S3; up to two decoys for each record go to S2. A test set also has a country that training lacks."""
    s, countries = F.lit(seed), COUNTRIES + ([TEST_COUNTRY] if test else [])
    row = F.col("id")
    number = F.concat(F.lit("No"), row.cast("string"))
    called = F.concat_ws(" ", F.initcap(_pick(FIRST, row, s, F.lit(1))), F.initcap(_pick(SECOND, row, s, F.lit(2))), number, _pick(FORMS, row, s, F.lit(3)))
    house = (F.pmod(F.xxhash64("id", s, F.lit(4)), F.lit(900)) + 1).cast("string")
    postal = (F.pmod(F.xxhash64("id", s, F.lit(6)), F.lit(90000)) + 10000).cast("string")
    placed = F.concat_ws(" ", house, _pick(STREETS, row, s, F.lit(5)), postal)
    base = spark.range(n).select("id", called.alias("name"), placed.alias("address"), _pick(countries, row, s, F.lit(7)).alias("country"))
    s1 = base.select(F.concat(F.lit("S1-"), F.col("id").cast("string")).alias("entity_id"), F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country")
    share = _chance(F.col("id"), s, F.lit(8))
    draws = F.when(share < SINGLETONS, 0).when(share < ONE_DRAW, 1).otherwise(2 + F.pmod(F.xxhash64("id", s, F.lit(9)), F.lit(2)).cast("int"))
    drawn = base.withColumn("draw", F.explode(F.when(draws > 0, F.sequence(F.lit(1), draws)).otherwise(F.array().cast("array<int>"))))
    source = F.when(_chance(F.col("id"), F.col("draw"), s) < 50, "S2").otherwise("S3")
    address = F.when(_chance(F.col("id"), F.col("draw"), s, F.lit(2)) < 30, F.regexp_replace(F.regexp_replace("address", "Road", "Rd"), "Street", "St")).otherwise(F.col("address"))
    copies = drawn.withColumn("source", source).select(F.concat_ws("-", "source", F.concat_ws("0", F.col("id").cast("string"), F.col("draw").cast("string"))).alias("entity_id"), "source", _edited(F.col("name"), F.pmod(F.xxhash64("id", "draw", s), F.lit(9)).cast("int")).alias("business_name"), address.alias("business_address"), "country", F.col("id").alias("of"))
    decoys = base.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(2)))).where(_chance(F.col("id"), F.col("draw"), s, F.lit(3)) < 50)
    own_id = F.concat_ws("-", F.lit("S2"), F.lit("d"), F.col("id").cast("string"), F.col("draw").cast("string"))
    trader = F.concat_ws(" ", F.initcap(_pick(FIRST, F.col("id"), F.col("draw"), s)), F.element_at(F.split("name", " "), 2), F.lit("Traders"))
    decoys = decoys.select(
        own_id.alias("entity_id"), F.lit("S2").alias("source"), trader.alias("business_name"), F.col("address").alias("business_address"), "country", F.lit(None).cast("long").alias("of")
    )
    pool = copies.unionByName(decoys)
    truth = pool.where("of is not null").select(F.concat(F.lit("S1-"), F.col("of").cast("string")).alias("s1_id"), "entity_id")
    return s1, pool.drop("of"), truth
