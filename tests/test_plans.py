"""The richer engine, experiments, stores and the synthetic lists, end to end on small lists."""

import json

import pytest

from linkloom.operators import decision, evaluation, features, sampling
from linkloom.plans import experiments, lifecycle, rich_lifecycle
from linkloom.functions import rich_text
from linkloom.sources import store, synthetic, tsv


@pytest.fixture(scope="module")
def lists(spark):
    return [df.persist() for df in synthetic.synthetic(spark, 80)]


def macro(matching, truth, s1):
    pairs = tsv.truth_pairs(matching.select("source1_entity_id", rich_text.match_list(matching.matched_entity_ids).alias("ids"))).withColumnsRenamed({"s1_id": "rid", "entity_id": "gid"})
    return evaluation.summary(evaluation.entity_scores(pairs, truth, s1)).first().macro_f05


def test_synthetic_shape(spark, lists):
    s1, pool, truth = lists
    counts = {r[0]: r[1] for r in truth.groupBy("s1_id").count().collect()}
    assert s1.count() == 80 and 0.15 < 1 - len(counts) / 80 < 0.45 and max(counts.values()) <= 3
    assert pool.select("entity_id").distinct().count() == pool.count()
    assert {r[0] for r in synthetic.synthetic(spark, 60, test=True)[0].select("country").distinct().collect()} == {"United States", "India", "France"}
    again = synthetic.synthetic(spark, 80)[1]
    assert sorted(map(tuple, again.repartition(7).collect())) == sorted(map(tuple, pool.collect()))


def test_rich_engine(spark, lists):
    s1, pool, truth = lists
    trained = rich_lifecycle.train_rich(s1, pool, truth, iterations=2, searches=False)
    assert len(trained.features) == 79 and trained.macro_f05 > 0.8
    assert macro(rich_lifecycle.predict_rich(s1, pool, trained), truth, s1) > 0.85


def test_experiments(spark, lists, tmp_path):
    s1, pool, truth = lists
    left, right, found = lifecycle.prepared_candidates(s1, pool)
    featured = features.pair_features(found, left, right)
    rows = sampling.labelled(featured, truth).selectExpr("*", "case when name_jw > 0.8 then 0 when name_jw > 0.6 then 1 else 2 end as tier").persist()
    rungs = experiments.ladder(rows, truth, s1, iterations=2)
    assert [r["experiment"] for r in rungs][:2] == ["exact name", "exact or core name"] and len(rungs) == 13 and rungs[8]["experiment"] == "+ calibration"
    assert rungs[-2]["macro_f05"] >= rungs[7]["macro_f05"] > 0.5
    tuned = experiments.tune(rows, truth, s1, features.FEATURES, trials=2, seconds=60)
    assert len(tuned) == 2 and tuned[0]["macro_f05"] >= tuned[1]["macro_f05"]
    for k in range(2):
        experiments.log_experiment(spark, str(tmp_path / "log"), f"e{k}", 0.5, decision.Decision(), note="x")
    logged = spark.read.parquet(str(tmp_path / "log")).collect()
    assert len(logged) == 2 and json.loads(logged[0].details)["note"] == "x"


def test_report(spark, lists):
    s1, pool, truth = lists
    gathered = tsv.id_lists(s1, truth.withColumnsRenamed({"s1_id": "rid", "entity_id": "gid"}), "matched_entity_ids")
    found, text = experiments.profile_report(pool, gathered.select("source1_entity_id", rich_text.match_list(gathered.matched_entity_ids).alias("ids")))
    assert found["truth"][0]["n_rows"] == 80 and "## countries" in text and json.dumps(found)


def test_report_files(spark, tmp_path):
    experiments.write_json(spark, str(tmp_path / "report"), {"é": [1, 2.5, None]})
    assert experiments.read_json(spark, str(tmp_path / "report")) == {"é": [1, 2.5, None]}
    experiments.write_csv(spark.createDataFrame([("a", 1), ("b", 2)], "block string, n int").repartition(3), str(tmp_path / "table"))
    assert sorted(map(tuple, spark.read.csv(str(tmp_path / "table"), header=True).collect())) == [("a", "1"), ("b", "2")]


def test_store(spark, lists):
    calls = []

    def make():
        calls.append(1)
        return lists[1]

    spark.sql("drop table if exists kept_records")
    first = store.stored(spark, "kept_records", make)
    assert store.stored(spark, "kept_records", make).count() == first.count() == lists[1].count() and len(calls) == 1
    one = lists[1].first()
    assert one.entity_id in [r[0] for r in store.lookup(first, business_name=one.business_name, country=one.country).collect()]
    spark.sql("drop table kept_records")
