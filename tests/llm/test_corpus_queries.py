"""The opN queries against DuckDB, and the pipeline against its stages' contracts."""

import re

import pytest

from linkloom.llm import common, simhash
from linkloom.llm import queries as corpus

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_equals_duckdb(name, spark, sf, duck):
    got = corpus.queries()[name](spark, sf)
    columns = sorted(got.columns)
    want = duck.sql(f"select {', '.join(columns)} from ({corpus.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want))


def test_there_are_ten():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in corpus.queries()) == list(range(1, 11))


def test_pipeline_by_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = common.documents(spark, sf)
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.materialize(stage(spark, docs, sf))
        seen[name] = docs
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    start, clean, single, near, masked = texts(common.documents(spark, sf)), *[texts(seen[n]) for n, _ in corpus_pipeline.STAGES[:4]]
    assert all(seen[n].columns == columns for n, _ in corpus_pipeline.STAGES[:4])
    toxic = {r.doc_id for r in common.labels(spark, sf).where("toxic = 1").collect()}
    gone = set(start) - set(clean)
    assert len(gone & toxic) >= 0.7 * len(toxic) and len(gone) < 0.2 * len(start)
    squeezed = {}
    for i, t in sorted(clean.items()):
        squeezed.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t), i)
    assert set(single) == set(squeezed.values())
    sets = {i: set(simhash.shingle_set(t.encode()).tolist()) for i, t in single.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
    holders = {}
    for i, own in sets.items():
        for h in own:
            holders.setdefault(h, set()).add(i)
    others = {i: {j for h in own for j in holders[h]} - {i} for i, own in sets.items()}
    assert not [(a, b) for a in near for b in others[a] & set(near) if alike(a, b)]
    assert all(any(alike(i, j) for j in others[i]) for i in set(single) - set(near))
    assert set(masked) == set(near) and not [t for t in masked.values() if re.search("[0-9a-f]{40}", t)]
    assert {i for i in near if near[i] == masked[i]} >= {i for i, t in near.items() if not re.search("(?i)token|password|AKIA|[A-Za-z0-9+/_-]{24}", t)}
    assert {r.doc_id for r in seen["packing"].collect()} == set(masked)
    assert corpus_pipeline.run(spark, sf).count() == seen["packing"].count()
