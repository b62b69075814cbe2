"""Prepared records kept as tables, and look-ups on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(spark: SparkSession, name: str, make: Callable[[], DataFrame], refresh: bool = False, statistics: bool = True) -> DataFrame:
    """The table, made if it isn't there; statistics of all columns go to the catalogue for the cost-based optimiser."""
    if refresh or not spark.catalog.tableExists(name):
        make().write.mode("overwrite").format("parquet").saveAsTable(name)
        if statistics:
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.table(name)


def lookup(records: DataFrame, limit: int = 200, **equal: str) -> DataFrame:
    """Ids of records whose views equal the given values, at most limit by id: a point query, pushed down to the scan."""
    out = records
    for column, value in equal.items():
        out = out.where(F.col(column) == F.lit(value))
    return out.select("entity_id").orderBy("entity_id").limit(limit)
