"""Exact deduplication: sorted digest runs, one for each input partition, merged in rounds up a tree. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, discard, materialize, small, whole_text

#: How many runs meet in one merge: each round takes three levels of a binomial tree at once.
FAN_IN = 8
KEY = ["digest", "proof", "size"]


def digests(docs: DataFrame) -> DataFrame:
    """(run, doc_id, raw, digest, proof, size) of every row.

    digest is the SHA-256 of the text with white space runs as one space, proof its SHA-1 and size its length: texts count as
    equal only if all three agree, at every level of the tree. raw is a hash of the text as it is, which tells rows of one
    doc_id apart. run is the partition the row is in.
    """
    body = F.regexp_replace(F.col("text"), f"{SPACE}+", " ")
    texts = docs.select("doc_id", whole_text().alias("text")).select("doc_id", F.xxhash64("text").alias("raw"), body.alias("body"))
    hashed = texts.select("doc_id", "raw", F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("digest"), F.unhex(F.sha1(F.col("body").cast("binary"))).alias("proof"), F.length("body").alias("size"))
    return hashed.select(F.spark_partition_id().alias("run"), "doc_id", "raw", *KEY)


def sorted_run(level: DataFrame) -> DataFrame:
    """One entry for each run and key of `level`, in key order: the multiway merge.

    Entries arrive sorted by run, key and id (an exchange by run and key, and a sort that merges sorted spills). An entry stays if
    its neighbour before it has another key; so the smallest id does, with the counts of all. As every run that
    comes in holds a key once, a key's group is never larger than the fan-in.
    """
    order = Window.partitionBy("run", *KEY).orderBy(F.col("keep_id").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.lag(F.lit(1)).over(order).isNull()
    return level.select("run", *KEY, "keep_id", F.sum("group_size").over(whole).alias("group_size"), first.alias("first")).where("first").drop("first")


def merged(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(digest, proof, size, keep_id, group_size) of materialized digests.

    Level 0 reduces every partition to a run, one entry for each key, before anything is shuffled; so a group that holds a third of
    all rows goes up as one entry for each run. In each further round the runs whose numbers agree after
    division by fan_in meet and are merged in order. A round is dealt out by run and key, so one merge is spread over
    all tasks. Null ids never win.
    """
    last = rows.agg(F.max("run")).first()[0] or 0
    level = rows.groupBy("run", *KEY).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    while last > 0:
        last //= fan_in
        level = sorted_run(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")))
    return level.drop("run")


def exact_groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null and missing texts count as empty and are equal to each other. Repeated rows of one doc_id count each in
    group_size; all of them carry kept = true if their id is the smallest. A null doc_id never stays while another row
    of the group has an id; kept is then false. An empty table gives no rows; other columns of docs are not read.
    Only groups of two rows or more are joined back; the plan is a plain outer join, so that
    adaptive execution can split a hot digest.
    """
    rows = materialize(digests(docs))
    joined = rows.join(merged(rows, fan_in).where("group_size > 1"), KEY, "left")
    keep = F.coalesce(F.col("keep_id"), F.col("doc_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == keep, F.col("group_size").isNull()).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """docs with its own columns, and of equal texts only the row with the smallest doc_id.

    Rows without a doc_id stay only if no row of their text has one, one row for each text. Repeated rows of the id that stays are
    reduced to one, the first in the order of their JSON form; a group's one row is never touched. Null texts count
    as empty; an empty table gives no rows. Whole rows meet only what has to go, by doc_id and a hash of the text as it is.
    """
    rows = materialize(digests(docs))
    groups = materialize(merged(rows, fan_in).where("group_size > 1").select(*KEY, "keep_id"))
    members = materialize(rows.join(groups, KEY).select("doc_id", "raw", *KEY, "keep_id"))
    lost = members.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "raw")
    again = members.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("doc_id", *KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialize(members.join(again.withColumnRenamed("doc_id", "keeper").drop("n"), KEY).where(F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "raw", "digest").distinct())
    gone = materialize(lost.union(again.select("doc_id", "raw")).distinct())
    discard(rows, groups, members)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("raw", F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
    out = small(gone.select(F.col("doc_id").alias("id_"), F.col("raw").alias("raw_")), gone.count())
    stay = packed.join(out, F.col("row.doc_id").eqNullSafe(F.col("id_")) & (F.col("raw") == F.col("raw_")), "left_anti").select("row")
    if again.limit(1).count():
        held = again.select(F.col("doc_id").alias("id_"), F.col("raw").alias("raw_"), "digest")
        repeated = packed.join(held, F.col("row.doc_id").eqNullSafe(F.col("id_")) & (F.col("raw") == F.col("raw_"))).groupBy("id_", "digest").agg(F.min_by("row", F.to_json("row")).alias("row"))
        stay = stay.union(repeated.select("row"))
    return stay.select("row.*")
