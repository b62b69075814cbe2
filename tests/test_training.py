"""Training rows that are equal travel as one, with their number as weight."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import model


def test_equal_training_rows_travel_as_one(spark):
    rows = spark.range(5050).selectExpr("case when id < 5000 then 1.0D else cast(id as double) end as x", "cast(id >= 5000 as int) as label")
    parts = model.condensed(rows, ["x", "label"])
    one = parts.groupBy("x", "label").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("parts")).collect()
    assert len(one) == 51 and sum(r.n for r in one) == pytest.approx(5050) and {r.parts for r in one} == {1, model.SHARES}
    trained = model.train(rows, ["x"], iterations=3)
    scored = trained.transform(spark.createDataFrame([(1.0,), (5010.0,)], "x double")).select("prediction").collect()
    assert [r.prediction for r in scored] == [0.0, 1.0]
