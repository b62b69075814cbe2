"""Each operator on nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from linkloom.llm import bpe, exact_dedup, license_scan, packing, pii, quality_rules, secret_scan, simhash, suffix_dedup, toxicity

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LONG = "word " * 40_000 + 'token = "0123456789abcdef0123456789abcdef01234567" ' + "é" * 3_000
ROWS = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (4, LONG), (None, "no id here"), (5, " \n\t "), (6, "one  two three"), (7, "日本語 😀 text")]
#: Names that operators use inside; none may clash with a column of the input.
CLASHES = ["score", "digest", "proof", "size", "run", "keep_id", "words", "lines", "fp", "head", "bands", "cell", "chunk", "bucket", "payload", "kind", "tie", "body", "value", "start", "label", "features", "spans", "row", "n", "bin", "shard", "piece"]


@pytest.fixture(scope="module")
def forest(spark):
    return secret_scan.train(secret_scan.made_findings(spark, 1_600), trees=8)


def operators(forest):
    model = pii.prior_model()
    return {
        "toxicity": lambda d: toxicity.toxicity_scores(d, toxicity.Model()), "packing": packing.packed, "license": license_scan.license_scan, "bpe": lambda d: bpe.digests(d, PATH, PATTERN),
        "secrets": lambda d: secret_scan.secret_findings(d, forest), "pii": lambda d: pii.pii_spans(d, model), "simhash": simhash.simhash_components, "suffix": suffix_dedup.repeated_bytes,
        "quality": quality_rules.quality_flags, "exact": exact_dedup.exact_groups,
    }


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


NAMES = ["toxicity", "packing", "license", "bpe", "secrets", "pii", "simhash", "suffix", "quality", "exact"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_row(name, spark, forest):
    got = operators(forest)[name](docs(spark, ROWS))
    ids = sorted((r.doc_id for r in got.select("doc_id").collect()), key=str)
    if name == "packing":
        ids = sorted((r.doc_id for r in got.where("piece = 0").collect()), key=str)
    want = [4] if name == "secrets" else sorted((r[0] for r in ROWS), key=str)
    assert ids == want


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_and_clashing_columns(name, spark, forest):
    op = operators(forest)[name]
    assert op(docs(spark, [])).count() == 0
    plain = docs(spark, ROWS)
    crowded = plain.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])
    key = lambda df: sorted(map(repr, df.collect()))
    first, second = op(plain), op(crowded)
    assert first.columns == second.columns
    assert key(first) == key(second)


@pytest.mark.parametrize("stage", ["toxic", "exact", "near", "redact"])
def test_stages_keep_columns(stage, spark, forest):
    f = {"toxic": lambda d: toxicity.drop_toxic(d, toxicity.Model()), "exact": exact_dedup.drop_exact_copies, "near": simhash.drop_near_duplicates, "redact": lambda d: secret_scan.redact(d, forest)}[stage]
    crowded = docs(spark, ROWS).select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])
    got = f(crowded)
    assert got.columns == crowded.columns
    assert f(crowded.limit(0)).count() == 0
    texts = [r.text for r in got.collect()]
    if stage == "exact":  # 1 and 2 are empty; 5 is one space; 3 twice and 6 are equal; a single row stays of each
        assert sorted(r.doc_id if r.doc_id is not None else -1 for r in got.collect()) == [-1, 1, 3, 4, 5, 7]
    elif stage == "redact":
        assert sum('token = "[secret]"' in (t or "") for t in texts) == 1 and len(texts) == len(ROWS)
    elif stage == "toxic":
        assert len(texts) == len(ROWS)
    else:  # equal words make a near copy: 6 goes with 3, whose rows stay
        assert sorted(r.doc_id if r.doc_id is not None else -1 for r in got.collect()) == [-1, 1, 2, 3, 3, 4, 5, 7]


def test_exact_groups(spark):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs(spark, ROWS)).collect()}
    assert got == {(1, 1, 2, True), (2, 1, 2, False), (3, 3, 3, True), (6, 3, 3, False), (4, 4, 1, True), (None, None, 1, True), (5, 5, 1, True), (7, 7, 1, True)}


@pytest.mark.parametrize("fan_in", [2, 3, 64])
def test_tree_shape_does_not_matter(fan_in, spark):
    many = docs(spark, [(k, f"text {k % 7 if k % 3 else 0}") for k in range(400)]).repartition(13)
    rows = exact_dedup.exact_groups(many, fan_in).collect()
    by = {}
    for k in range(400):
        by.setdefault(k % 7 if k % 3 else 0, []).append(k)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows} == {(k, min(g), len(g), k == min(g)) for g in by.values() for k in g}


def test_partitions_without_anything_to_count(spark):
    plain = docs(spark, [(k, "") for k in range(6)]).repartition(6)
    assert pii.pii_spans(plain).count() == 6 and license_scan.license_scan(plain).count() == 6
    labels = spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(plain, toxicity.fit(plain, labels)).count() == 6
    assert pii.pii_spans(plain.limit(0)).count() == 0 and license_scan.license_scan(plain.limit(0)).count() == 0


def test_copies_that_tie_in_id_are_reduced_alike(spark):
    rows = [(1, "a  b", "x"), (1, "a b", "y"), (1, "a b", "x"), (1, "other", "x"), (2, "a b", "x"), (None, "a b", "x"), (None, "z", "q"), (None, "z", "p"), (3, None, "x"), (4, "", "x")]
    for parts in (1, 3, 8):
        for order in (rows, rows[::-1]):
            got = exact_dedup.drop_exact_copies(spark.createDataFrame(order, "doc_id long, text string, note string").repartition(parts)).collect()
            assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, "a  b", "x"), (1, "other", "x"), (None, "z", "p"), (3, None, "x")]))


def test_a_large_group_goes_up_as_one_entry_for_each_run(spark):
    rows = docs(spark, [(k, "same  text" if k % 3 else f"own {k}") for k in range(3_000)]).repartition(20)
    level = exact_dedup.materialize(exact_dedup.digests(rows))
    got = {(r.keep_id, r.group_size) for r in exact_dedup.merged(level, 2).where("group_size > 1").collect()}
    assert got == {(1, 2_000)} and exact_dedup.drop_exact_copies(rows).count() == 1_001
