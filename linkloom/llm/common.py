"""What the corpus operators share: null-safe text, tables written to the shared folder, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"
#: Rows of two numbers that a broadcast may hold: some 16 MB in each executor.
BROADCAST_ROWS = 500_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def whole_text(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Only a local master, as in tests, may leave it unset: executors of a cluster don't share a machine's folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (path or "/tmp/checkpoints/linkloom").rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read back: it cuts the lineage, survives lost executors and is
    computed once, where checkpoint() computes its last stage twice. discard() deletes what no result needs any more."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes materialized tables. The caller has materialized all that was computed from them."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df of some numbers a row, broadcast if its counted rows are few enough; else any join of it shuffles both sides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: (node, component), component being the smallest node reachable.

    edges: two bigint columns a, b; loops, repeats and either direction are fine; null ends are ignored. Only nodes with
    an edge come out; no edges give no rows. Each round takes the smallest label among the neighbours, then
    follows that label's own label (pointer jumping), so rounds grow with the logarithm of a path's length. Messages
    to a hub are combined before the shuffle by the partial minimum. Each round is written to the shared folder.
    """
    clean = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = materialize(clean.union(clean.select("b", "a")).distinct())
    labels_ = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    last = labels_
    for _ in range(most_rounds):
        seen = both.join(labels_.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels_.join(seen.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # the label of my label, which may have sunk in this or an earlier round
        above = labels_.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = materialize(hooked.join(above, "label", "left").select("node", "old", F.least("label", F.coalesce("above", "label")).alias("label")))
        changed = jumped.where("label <> old").limit(1).count()
        discard(last)
        last, labels_ = jumped, jumped.select("node", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    discard(both)
    return labels_.select("node", F.col("label").alias("component"))
