"""Decisions, evaluation, sampling, checks, sources and plans on small hand-made cases."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import blocking, checks, decision, evaluation, features, ids, model, sampling
from linkloom.plans import lifecycle
from linkloom.sources import tsv
from linkloom.streaming.stream import match_stream

RECORD = "entity_id string, business_name string, business_address string, country string"


def pairs(spark, rows):
    return spark.createDataFrame(rows, "rid string, gid string, source string, p double")


def truth(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, entity_id string")


def entities(spark, names):
    return spark.createDataFrame([(n,) for n in names], "entity_id string")


@pytest.mark.parametrize(
    ("want", "got", "score"),
    [(set(), set(), 1.0), (set(), {"a"}, 0.0), ({"a"}, set(), 0.0), ({"a"}, {"a"}, 1.0), ({"a", "b"}, {"a"}, 0.833333), ({"a"}, {"a", "b"}, 0.555556), ({"a"}, {"b"}, 0.0)],
)
def test_entity_score(spark, want, got, score):
    scores = evaluation.entity_scores(pairs(spark, [("x", f"S2-{g}", "S2", 1.0) for g in got]), truth(spark, [("x", f"S2-{w}") for w in want]), entities(spark, ["x"]))
    assert scores.first().f05 == pytest.approx(score, abs=1e-6)


def test_decisions(spark):
    scored = pairs(spark, [("x", "S2-1", "S2", 0.9), ("x", "S3-1", "S3", 0.88), ("x", "S2-2", "S2", 0.5), ("y", "S2-3", "S2", 0.6), ("y", "S2-4", "S2", 0.6), ("z", "S3-9", "S3", 0.2)])
    ids_ = lambda **o: sorted(r.gid for r in decision.accepted(scored, decision.Decision(**o)).collect())
    assert ids_(threshold=0.5) == ["S2-1", "S2-2", "S2-3", "S2-4", "S3-1"]
    assert ids_(threshold=0.5, threshold_s2=0.7, threshold_s3=0.9) == ["S2-1"]
    assert ids_(threshold=0.5, top_only=True) == ["S2-1", "S2-3"]
    assert ids_(threshold=0.5, margin=0.05) == ["S2-1", "S2-3"]
    assert ids_(threshold=0.5, max_matches=1) == ["S2-1", "S2-3"]
    assert ids_(threshold=1.1, high_conf=0.89) == ["S2-1"]


def test_sweep_equals_one_by_one(spark):
    scored = pairs(spark, [(f"e{i % 9}", f"S2-{i}", "S2", round(((i * 37) % 101) / 100, 2)) for i in range(120)])
    want = truth(spark, [(f"e{i % 9}", f"S2-{i}") for i in range(0, 120, 3)] + [("e8", "S2-none")])
    everyone = entities(spark, [f"e{i}" for i in range(11)])
    swept = {r.threshold: r.macro_f05 for r in decision.threshold_sweep(scored, want, everyone, decision.COARSE).collect()}
    for t in (0.3, 0.5, 0.875, 0.975):
        assert swept[t] == pytest.approx(decision.macro(scored, want, everyone, decision.Decision(threshold=t)))


def test_source_search_equals_brute_force(spark):
    scored = pairs(spark, [(f"e{i % 7}", f"S{2 + i % 2}-{i}", f"S{2 + i % 2}", ((i * 53) % 97) / 97) for i in range(80)])
    want = truth(spark, [(f"e{i % 7}", f"S{2 + i % 2}-{i}") for i in range(0, 80, 2)])
    everyone = entities(spark, [f"e{i}" for i in range(7)])
    base = decision.Decision(threshold=0.6)
    best, score = decision.best_source_thresholds(scored, want, everyone, base, [0.3, 0.6, 0.9])
    assert score == pytest.approx(decision.macro(scored, want, everyone, best))
    assert score >= decision.macro(scored, want, everyone, base)


def test_consistency(spark):
    scored = pairs(spark, [("x", "S2-1", "S2", 0.95), ("x", "S3-1", "S3", 0.4), ("y", "S3-2", "S3", 0.4)])
    assert sorted(r.gid for r in decision.consistent(scored, scored).collect()) == ["S2-1", "S3-2"]


def test_errors(spark):
    scored = pairs(spark, [("x", "S2-1", "S2", 0.9), ("x", "S2-2", "S2", 0.3)])
    got = {(r.gid, r.kind): r for r in decision.errors(scored, scored.where("p > 0.5"), truth(spark, [("x", "S2-2")])).collect()}
    assert set(got) == {("S2-1", "FP"), ("S2-2", "FN")}
    assert got["S2-2", "FN"].margin == pytest.approx(0.6) and got["S2-2", "FN"].n_candidates == 2


def test_surrogate_ids(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(50)], "k string")
    got = ids.surrogate_ids(df.repartition(5), ["k"]).orderBy("k").collect()
    assert [r.gid for r in got] == list(range(50))
    assert ids.surrogate_ids(df.limit(0), ["k"]).count() == 0


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def test_caps_drop_a_key_whole(spark):
    s1 = records(spark, [("S1-1", "Acme", None, "x")])
    pool = records(spark, [(f"S2-{i}", "Acme", f"{i} Street", "x") for i in range(201)]).withColumn("source", F.lit("S2"))
    from linkloom.functions import text

    found = lambda n: blocking.candidates(text.prepare(s1), text.prepare(pool.limit(n))).count()
    assert (found(200), found(201)) == (200, 0)


def test_empty_and_null_records(spark):
    from linkloom.functions import text

    s1 = text.prepare(records(spark, [("S1-1", None, None, None), ("S1-2", "", "", ""), (None, "a", "b", "c")]))
    pool = text.prepare(records(spark, [("S2-1", None, None, None)]).withColumn("source", F.lit("S2")))
    assert blocking.candidates(s1, pool).count() == 0
    assert blocking.candidates(s1.limit(0), pool.limit(0)).count() == 0


def test_sampling(spark):
    rows = spark.createDataFrame([(f"e{i % 3}", f"S2-{i}", int(i % 50 == 0)) for i in range(300)], "rid string, gid string, label int")
    kept = sampling.sample_negatives(rows, 5)
    assert kept.where("label = 1").count() == rows.where("label = 1").count()
    for r in kept.groupBy("rid").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).collect():
        assert r.neg <= max(5, 5 * r.pos)
    mined = sampling.mine(rows.withColumn("tier", F.col("gid").substr(4, 3).cast("int") % 4), 20)
    assert mined.where("label = 1").count() == 6 and mined.where("label = 0 and tier = 3").count() < rows.where("label = 0").count() / 8
    split = sampling.split_entities(entities(spark, [f"e{i}" for i in range(1000)])).groupBy("split").count().collect()
    assert {r.split: 100 < r["count"] for r in split} == {"train": True, "validation": True}


def test_problems_are_found(spark):
    s1, pool = entities(spark, ["S1-1", "S1-2", "S1-3"]), entities(spark, ["S2-1", "S3-1"])
    matching = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-2"), ("S1-9", "S2-7"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    proposed = spark.createDataFrame([("S1-1", "S3-1,S2-8"), ("S1-1", "")], "source1_entity_id string, candidate_entity_ids string")
    got = {r.kind: r.n for r in checks.problems(matching, proposed, s1, pool).collect()}
    assert got == {
        "unknown S1 id": 1, "duplicate S1 row": 1, "S1 id omitted": 1, "duplicate matched ids": 1, "S1 id used as match": 1, "match id unknown": 1, "duplicate S1 row in candidates": 1, "candidate id unknown": 1, "match not in candidates": 3,
    }


def test_tsv_round_trip(spark, tmp_path):
    (tmp_path / "__MACOSX").mkdir()
    (tmp_path / "__MACOSX" / "a.tsv").write_text("x")
    (tmp_path / "._a.tsv").write_text("x")
    path = tmp_path / "train_source2.tsv"
    path.write_text('﻿ID\tCompany Name\tStreet Address\nS2-1\tAcme "Foods\t1 Road\nS2-2\tNo address\n', encoding="utf-8")
    assert list(tsv.discover(str(tmp_path))) == ["train_source2.tsv"]
    rows = {r.entity_id: r for r in tsv.records(spark, str(path)).collect()}
    assert rows["S2-1"].business_name == 'Acme "Foods' and rows["S2-1"].country is None and rows["S2-2"].business_address is None
    other = tmp_path / "other.tsv"
    other.write_text("Country\tNotes\nFrance\tx\n")
    with pytest.raises(ValueError, match="no id column"):
        tsv.records(spark, str(other))
    header = ["Company_Name", "Entity", "Nation code", "Street Address", "my id"]
    assert [tsv.column_for(header, c) for c in tsv.COLUMNS] == [1, 0, 3, 2] and tsv.column_for(["x", "width"], "entity_id") == 1
    ragged = tmp_path / "ragged.tsv"
    ragged.write_text("id\tname\na\tb\tc\n")
    assert tsv.records(spark, str(ragged)).first().business_name == "b"
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tsv.records(spark, str(ragged), quotes=True, strict=True).collect()
    assert tsv.row_count(spark, str(path)) == 2 and tsv.records(spark, str(path), limit=1).count() == 1
    gt = tmp_path / "truth.tsv"
    gt.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n")
    assert sorted(map(tuple, tsv.truth_pairs(tsv.truth_lists(spark, str(gt))).collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-2")]
    s1 = entities(spark, ["S1-1", "S1-2"])
    lists = tsv.id_lists(s1, spark.createDataFrame([("S1-1", "S3-2"), ("S1-1", "S2-1")], "rid string, gid string"), "matched_entity_ids")
    tsv.write(lists, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), sep="\t", header=True)
    assert {r[0]: r[1] or "" for r in back.collect()} == {"S1-1": "S2-1,S3-2", "S1-2": ""}


def linkage(spark, n=160):
    """Clean records and noisy copies, made from numbers; some have no copy and some none but a decoy."""
    words = ["alpha", "birch", "cedar", "delta", "ember", "fjord", "grove", "heath", "inlet", "juniper", "knoll", "larch"]
    name = lambda i: f"{words[i % 12]} {words[(i * 7 + i // 12) % 12]} {words[(i * 5 + 3) % 12]}{i}"
    s1 = [(f"S1-{i}", f"{name(i)} Limited", f"{i} Oak Road {10000 + i}", "India") for i in range(n)]
    pool, gold = [], []
    for i in range(n):
        if i % 3:
            pool.append((f"S2-{i}", f"{name(i).upper()} LTD", f"{i} oak rd {10000 + i}", "India", "S2"))
            gold.append((f"S1-{i}", f"S2-{i}"))
        if i % 4 == 0:
            pool.append((f"S3-{i}", f"{name(i)[:-1]}x Ltd", f"{i + 500} Elm Road {10000 + i}", "India", "S3"))
    return records(spark, s1), spark.createDataFrame(pool, RECORD + ", source string"), truth(spark, gold)


def test_train_predict_save(spark, tmp_path):
    s1, pool, gold = linkage(spark)
    trained = lifecycle.train(s1, pool, gold, iterations=5)
    assert trained.macro_f05 > 0.9 and trained.recall.first().recall > 0.95
    model.save(trained.model, trained.decision, features.FEATURES, str(tmp_path / "m"))
    loaded, d, columns = model.load(spark, str(tmp_path / "m"))
    assert d == trained.decision and columns == features.FEATURES
    matching, proposed = lifecycle.predict(s1, pool, lifecycle.Trained(loaded, d, 0.0, trained.recall))
    assert matching.count() == s1.count() == proposed.count()
    assert sum(r.n for r in checks.problems(matching, proposed, s1, pool).collect()) == 0
    got = {r[0]: set(filter(None, r[1].split(","))) for r in matching.collect()}
    right = sum(got[a] == {b} for a, b in gold.collect())
    assert right > 0.9 * gold.count()
    assert model.importance(trained.model, features.FEATURES)[0][1] > 0


def test_stream_equals_batch(spark, tmp_path):
    s1, pool, _ = linkage(spark, 40)
    s1.repartition(2).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(s1.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    match_stream(arriving, pool, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "out")).select("source1_entity_id", "matched_entity_ids").collect()}
    matches = decision.accepted(lifecycle.rule_scores(s1, pool), decision.Decision(threshold=0.8))
    assert got == {tuple(r) for r in tsv.id_lists(s1, matches, "matched_entity_ids").collect()}


def test_calibration(spark):
    scored = pairs(spark, [(f"e{i}", f"S2-{i}", "S2", 0.1 + 0.2 * (i % 3 == 0)) for i in range(90)])
    gold = truth(spark, [(f"e{i}", f"S2-{i}") for i in range(0, 90, 3)])
    rows = sampling.labelled(scored, gold)
    kind, fitted, score = model.best_calibrator(rows, gold, entities(spark, [f"e{i}" for i in range(90)]))
    assert kind != "none" and score > 0.99 and 0 <= model.calibrate(kind, fitted, rows).agg(F.min("p")).first()[0]
