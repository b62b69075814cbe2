"""The record-linkage queries by name, and the SQL that DuckDB checks them with. Every query reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rich_text, text
from ..functions.similarity import ratios
from ..operators import blocking, checks, decision, evaluation, features, ids, model, profile, retrieval, rich_features, sampling
from ..session import table
from ..sources import adapters, synthetic
from ..sources.tsv import id_lists
from . import experiments, lifecycle, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
THRESHOLD = 0.8
BASE = decision.Decision(threshold=THRESHOLD)


def query(sql: str | None = None, name: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return register


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _prepared(spark: SparkSession, sf_dir: str):
    s1, pool, truth = adapters.trade(spark, sf_dir)
    return text.prepare(s1), text.prepare(pool), truth


def _scored(spark: SparkSession, sf_dir: str):
    s1, pool, truth = _prepared(spark, sf_dir)
    return features.rule_score(features.pair_features(blocking.candidates(s1, pool), s1, pool)), s1, pool, truth


_KEPT: list[DataFrame] = []


def _keep(*frames: DataFrame, anew: bool = True) -> list[DataFrame]:
    """Keeps frames that a lazy result reads more than once, and lets go of those of the query before."""
    if anew:
        while _KEPT:
            _KEPT.pop().unpersist()
    kept = [f.persist() for f in frames]
    _KEPT.extend(kept)
    return kept


def _rich(spark: SparkSession, sf_dir: str):
    s1, pool, truth = adapters.directory(spark, sf_dir)
    return *_keep(rich_text.prepare(s1), rich_text.prepare(pool)), truth  # read by every block


# Text views over whole documents, each computed from the one before
@query(f"select doc_id, {text.duck_name('text')} as view from documents")
def norm_name(spark, d):
    return table(spark, d, "documents").select("doc_id", text.name(F.col("text")).alias("view"))


@query(f"select doc_id, {text.duck_heavy('text')} as view from documents")
def norm_heavy(spark, d):
    return norm_name(spark, d).select("doc_id", text.heavy_of(F.col("view")).alias("view"))


@query(f"select doc_id, {text.duck_core('text')} as view from documents")
def norm_core(spark, d):
    return norm_heavy(spark, d).select("doc_id", text.core_of(F.col("view")).alias("view"))


@query(f"select doc_id, {text.duck_address('text')} as view from documents")
def norm_addr(spark, d):
    return table(spark, d, "documents").select("doc_id", text.address(F.col("text")).alias("view"))


@query(f"select doc_id, regexp_extract({text.duck_address('text')}, '([0-9]{{1,6}})', 1) as house from documents")
def extract_house(spark, d):
    return table(spark, d, "documents").select("doc_id", text.house(text.address(F.col("text"))).alias("house"))


@query(f"select doc_id, regexp_extract({text.duck_address('text')}, '\\b([0-9]{{5,6}})\\b', 1) as postal from documents")
def extract_postal(spark, d):
    return table(spark, d, "documents").select("doc_id", text.postal(text.address(F.col("text"))).alias("postal"))


_VIEWS = ["name", "name_heavy", "name_core", "addr", "country", "name_prefix", "addr_prefix", "house", "postal"]


@query(oracle.records("select entity_id, " + ", ".join(_VIEWS) + " from s1 union all select entity_id, " + ", ".join(_VIEWS) + " from pool"))
def prepared_records(spark, d):
    s1, pool, _ = _prepared(spark, d)
    return s1.select("entity_id", *_VIEWS).union(pool.select("entity_id", *_VIEWS))


@query(oracle.records("select entity_id, source, row_number() over (order by source, entity_id) - 1 as gid from pool"))
def surrogate_ids(spark, d):
    return ids.surrogate_ids(adapters.trade(spark, d)[1].select("entity_id", "source"), ["source", "entity_id"])


# Blocks, caps, merge, rank
for _b in blocking.BLOCKS:
    query(oracle.records(f", blocks as ({oracle.block_pairs([_b])}) select rid, gid, source, bit from blocks"), f"block_{_b.name}")(lambda spark, d, b=_b: blocking.block_pairs(*_prepared(spark, d)[:2], [b]))


@query(oracle.prefix_blocks())
def block_prefixes(spark, d):
    return blocking.block_pairs(*_prepared(spark, d)[:2], blocking.PREFIX_BLOCKS)


@query(oracle.records(f"select bit, key, n, kept from ({oracle.key_tables()})"))
def key_caps(spark, d):
    return blocking.key_counts(_prepared(spark, d)[1])


@query(oracle.upto("ranked", "select rid, gid, source, block_mask, block_count, rn from ranked"))
def candidate_merge(spark, d):
    return blocking.ranked(blocking.merge(blocking.block_pairs(*_prepared(spark, d)[:2])))


@query(oracle.upto("found", "select * from found"))
def candidate_topk(spark, d):
    return blocking.candidates(*_prepared(spark, d)[:2])


# Pair features
_SETS = {
    "pair_exact_features": ["name_exact", "name_heavy_exact", "name_core_exact", "addr_exact", "house_match", "postal_match", "country_equal", "country_conflict"], "pair_jw": ["name_jw", "addr_jw", "name_partial"],
    "pair_jaro": ["name_jaro"], "pair_lev": ["name_lev_ratio", "addr_lev_ratio"], "pair_token_cov": ["name_token_jaccard", "addr_token_jaccard", "name_len_ratio", "addr_len_ratio"], "pair_all25": features.FEATURES,
}


def _features(spark, d, columns):
    s1, pool, _ = _prepared(spark, d)
    return features.rounded(features.pair_features(blocking.candidates(s1, pool), s1, pool).select("rid", "gid", "source", *columns))


for _name, _columns in _SETS.items():
    query(oracle.features(_columns), _name)(lambda spark, d, c=_columns: _features(spark, d, c))


@query(oracle.upto("scored", "select * from scored"))
def rule_scores(spark, d):
    return _scored(spark, d)[0]


# Decisions
_DECISIONS = {
    "decision_threshold": {}, "decision_source_thresholds": {"threshold_s2": 0.75, "threshold_s3": 0.85}, "decision_top_only": {"top_only": True}, "decision_margin": {"margin": 0.05}, "decision_max": {"max_matches": 2},
}
_ARGS = {"threshold_s2": "s2", "threshold_s3": "s3", "max_matches": "most"}
for _name, _options in _DECISIONS.items():
    query(oracle.upto("scored", "select * from matches", oracle.accepted(THRESHOLD, **{_ARGS.get(k, k): v for k, v in _options.items()})), _name)(
        lambda spark, d, o=_options: decision.accepted(_scored(spark, d)[0], decision.Decision(threshold=THRESHOLD, **o))
    )


@query(oracle.upto("scored", "select * from matches", oracle.accepted(THRESHOLD, high=0.999)))
def decision_production(spark, d):
    return decision.production_decision(_scored(spark, d)[0], THRESHOLD)


_SWEEP = f"""grid as (select unnest([{', '.join(map(str, decision.COARSE))}]::double[]) as threshold), hits as (select s.*, (t.s1_id is not null)::int as hit from scored s left join truth t on t.s1_id = rid and t.entity_id = gid),
  per as (select threshold, e.rid, n_truth, coalesce(tp, 0) as tp, coalesce(n_pred, 0) as n_pred from (select threshold, s1.entity_id as rid, (select count(*) from truth t where t.s1_id = s1.entity_id) as n_truth from grid, s1) e
    left join (select threshold, rid, count(*) as n_pred, sum(hit) as tp from grid join hits on p >= least(threshold, 0.995) group by threshold, rid) g using (threshold, rid))"""


@query(oracle.upto("scored", f"select threshold, round(avg({oracle.F_HALF}), 6) as macro_f05 from per group by threshold", _SWEEP))
def threshold_sweep(spark, d):
    scored, s1, _, truth = _scored(spark, d)
    return _round(decision.threshold_sweep(scored, truth, s1, decision.COARSE))


_CONSISTENT = """best as (select rid, gid, max(p) as best from scored group by rid, gid), strong as (select m.rid, m.gid, m.source, best, max(best) over (partition by m.rid, m.source) as strongest, max(best) over (partition by m.rid) as overall from matches m join best using (rid, gid))"""


@query(oracle.upto("scored", "select rid, gid, source, best as p from strong where not (best < 0.65 and strongest < overall and strongest < 0.9 * overall)", f"{oracle.accepted(0.5)}, {_CONSISTENT}"))
def consistency(spark, d):
    scored = _scored(spark, d)[0]
    return decision.consistent(decision.accepted(scored, decision.Decision(threshold=0.5)), scored, demote_ratio=0.9, min_prob=0.65)


@query()
def best_decision(spark, d):
    """One row: the decision that the three searches end with."""
    scored, s1, _, truth = _scored(spark, d)
    scored = scored.persist()
    first, _ = decision.best_threshold(scored, truth, s1)
    second, _ = decision.best_source_thresholds(scored, truth, s1, first)
    last, score = decision.best_ambiguity(scored, truth, s1, second)
    scored.unpersist()
    return spark.createDataFrame([(last.threshold, last.threshold_s2, last.threshold_s3, last.margin, last.top_only, last.max_matches, score)], "threshold double, threshold_s2 double, threshold_s3 double, margin double, top_only boolean, max_matches int, macro_f05 double")


# Evaluation
_EVAL = f"{oracle.accepted(THRESHOLD)}, {oracle.JUDGED}, {oracle.SCORES}"


def _judged(spark, d):
    scored, s1, _, truth = _scored(spark, d)
    return decision.accepted(scored, BASE), truth, s1


_RATE = "case when {0} + {1} > 0 then {0} / ({0} + {1}) else 0.0 end"


@query(oracle.upto("scored", f"""select round(avg(f05), 6) as macro_f05, round({_RATE.format('sum(tp)', 'sum(fp)')}, 6) as precision, round({_RATE.format('sum(tp)', 'sum(fn)')}, 6) as recall, count(*) as n_entities, count(*) filter (n_truth > 0) as n_entities_with_truth,
  round(coalesce(avg(f05) filter (n_truth = 0), 0), 6) as singleton_score, round(coalesce(avg(f05) filter (n_truth > 0), 0), 6) as match_score, sum(tp)::bigint as tp, sum(fp)::bigint as fp, sum(fn)::bigint as fn, sum(n_pred)::bigint as n_predicted_pairs from scores""", _EVAL))  # fmt: skip
def eval_macro(spark, d):
    return _round(evaluation.summary(evaluation.entity_scores(*_judged(spark, d))))


@query(oracle.upto("scored", "select rid, tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, n_pred::bigint as n_pred, n_truth::bigint as n_truth, round(f05, 6) as f05 from scores", _EVAL))
def eval_entities(spark, d):
    return _round(evaluation.entity_scores(*_judged(spark, d)))


@query(oracle.upto("scored", f"""select source, tp, fp, fn, round(precision, 6) as precision, round(recall, 6) as recall, round(case when 0.25 * precision + recall > 0 then 1.25 * precision * recall / (0.25 * precision + recall) else 0.0 end, 6) as f05 from
  (select *, {_RATE.format('tp', 'fp')} as precision, {_RATE.format('tp', 'fn')} as recall from (select source, sum(pred * truth)::bigint as tp, sum(pred * (1 - truth))::bigint as fp, sum((1 - pred) * truth)::bigint as fn from judged group by source))""", _EVAL))  # fmt: skip
def eval_by_source(spark, d):
    matches, truth, _ = _judged(spark, d)
    return _round(evaluation.by_source(matches, truth))


@query(oracle.upto("scored", "select case when country = '' then '(empty)' else country end as country, round(avg(f05), 6) as macro_f05, count(*) as n from scores join s1 on s1.entity_id = rid group by 1", _EVAL))
def eval_by_country(spark, d):
    matches, truth, s1 = _judged(spark, d)
    return _round(evaluation.by_country(evaluation.entity_scores(matches, truth, s1), s1))


_WRONG = f"""{oracle.accepted(THRESHOLD)}, wrong as (select rid, gid, 'FP' as kind from matches m where not exists (select 1 from truth t where t.s1_id = m.rid and t.entity_id = m.gid) union all
  select s1_id, entity_id, 'FN' from truth t where not exists (select 1 from matches m where t.s1_id = m.rid and t.entity_id = m.gid)),
  tops as (select rid, max(case when rn = 1 then p end) as top, coalesce(max(case when rn = 2 then p end), 0) as second, count(*) as n_candidates from (select *, row_number() over (partition by rid order by p desc, gid) as rn from scored) group by rid)"""


@query(oracle.upto("scored", "select rid, gid, kind, s.p, top, second, n_candidates, round(top - second, 6) as margin from wrong left join (select rid, gid, max(p) as p from scored group by rid, gid) s using (rid, gid) left join tops using (rid)", _WRONG))
def error_analysis(spark, d):
    scored, _, _, truth = _scored(spark, d)
    return _round(decision.errors(scored, decision.accepted(scored, BASE), truth))


# Candidate sets
@query(oracle.upto("found", """select found, total, round(found / total, 6) as recall, n_pairs, round(1 - n_pairs / (n1 * n2), 6) as reduction_ratio
  from (select (select count(*) from truth t join found f on f.rid = t.s1_id and f.gid = t.entity_id) as found, (select count(*) from truth) as total,
    (select count(*) from found) as n_pairs, (select count(*) from s1) as n1, (select count(*) from pool) as n2)"""))
def candidate_recall(spark, d):
    s1, pool, truth = _prepared(spark, d)
    return _round(evaluation.candidate_recall(blocking.candidates(s1, pool), truth, s1, pool))


for _by, _expr in (("source", "split_part(t.entity_id, '-', 1)"), ("country", "case when s1.country = '' then '(empty)' else s1.country end")):
    query(oracle.upto("found", f"select {_expr} as {_by}, count(f.rid) as found, count(*) as total, round(count(f.rid) / count(*), 6) as recall from truth t join s1 on s1.entity_id = t.s1_id left join found f on f.rid = t.s1_id and f.gid = t.entity_id group by 1"), f"recall_by_{_by}")(
        lambda spark, d, by=_by: _round(evaluation.recall_by(blocking.candidates(*_prepared(spark, d)[:2]), _prepared(spark, d)[2], _prepared(spark, d)[0], by))
    )
for _zero in (True, False):
    _counts = "select coalesce(n, 0) as n from s1 left join (select rid, count(*) as n from found group by rid) c on c.rid = s1.entity_id" + ("" if _zero else " where n is not null")
    query(oracle.upto("found", f"select count(*) as entities, round(avg(n), 6) as mean, quantile_cont(n, 0.5)::double as median, round(quantile_cont(n, 0.95), 6) as p95, round(quantile_cont(n, 0.99), 6) as p99, max(n) as max from ({_counts})"), "candidate_distribution" if _zero else "candidate_distribution_nonzero")(
        lambda spark, d, z=_zero: _round(evaluation.candidate_distribution(blocking.candidates(*_prepared(spark, d)[:2]), _prepared(spark, d)[0], z))
    )


@query(oracle.upto("blocks", "select bit, count(*) as pairs, count(t.s1_id) as positives, round(count(t.s1_id) / (select count(*) from truth), 6) as recall, round(count(*) / count(distinct rid), 6) as mean_pairs from blocks left join truth t on t.s1_id = rid and t.entity_id = gid group by bit"))
def block_recall(spark, d):
    s1, pool, truth = _prepared(spark, d)
    return _round(evaluation.block_recall(blocking.block_pairs(s1, pool), truth))


@query(oracle.upto("found", "select rid, gid, source, block_mask, block_count from found union all select t.s1_id, t.entity_id, pool.source, 0, 0 from truth t join pool using (entity_id) where not exists (select 1 from found f where f.rid = t.s1_id and f.gid = t.entity_id)"))
def inject_positives(spark, d):
    s1, pool, truth = _prepared(spark, d)
    return sampling.inject_positives(blocking.candidates(s1, pool), truth, pool)


_LABELLED = "labelled as (select s.*, (t.s1_id is not null)::int as label from scored s left join truth t on t.s1_id = rid and t.entity_id = gid)"


def _labelled(spark, d):
    scored, _, _, truth = _scored(spark, d)
    return sampling.labelled(scored, truth)


@query(oracle.upto("scored", "select * from labelled", _LABELLED))
def labelled_pairs(spark, d):
    return _labelled(spark, d).select("rid", "gid", "source", "p", "label")


def _key(columns: str, seed: int = sampling.SEED) -> str:
    """sampling.key() in SQL."""
    return f"('0x' || substr(md5(concat_ws('|', {columns}, '{seed}')), 1, 8))::bigint"


@query(oracle.upto("scored", f"select rid, gid, source, p, label from (select *, sum(label) over (partition by rid) as pos, row_number() over (partition by rid, label order by {_key('rid, gid')}, gid) as k from labelled) where label = 1 or k <= greatest(3 * pos, 3)", _LABELLED))
def sample_negatives(spark, d):
    return sampling.sample_negatives(_labelled(spark, d), 3)


_TIER = """case
  when (name_jw >= 0.85 and addr_jw >= 0.85) or name_core_exact > 0 or (name_jw >= 0.90 and (postal_match > 0 or house_match > 0)) then 0
  when name_jw >= 0.72 or (name_jw >= 0.55 and addr_jw >= 0.70) or (name_jw >= 0.60 and house_match > 0) or name_token_jaccard >= 0.80 then 1
  when name_jw >= 0.45 or name_token_jaccard >= 0.5 or name_token_jaccard >= 0.60 or addr_jw >= 0.75 then 2
  else 3 end"""


def _tiers(spark, d):
    s1, pool, truth = _prepared(spark, d)
    rows = sampling.labelled(features.pair_features(blocking.candidates(s1, pool), s1, pool), truth)
    c = F.col
    return rows.withColumn("tier", sampling.difficulty(c("name_jw"), c("name_token_jaccard"), c("name_core_exact"), c("addr_jw"), c("postal_match"), c("house_match"), c("name_token_jaccard")))


@query(oracle.upto("feats", f"select label, tier, count(*) as n from (select (t.s1_id is not null)::int as label, {_TIER} as tier from feats left join truth t on t.s1_id = rid and t.entity_id = gid) group by label, tier"))
def tier_budget(spark, d):
    return _tiers(spark, d).groupBy("label", "tier").agg(F.count(F.lit(1)).alias("n"))


def _mined() -> str:
    """The budget spent tier by tier, then the rows of each tier with the smallest hashes."""
    marked = f"tiers as (select rid, gid, (t.s1_id is not null)::int as label, {_TIER} as tier from feats left join truth t on t.s1_id = rid and t.entity_id = gid)"
    rate = "case tier " + " ".join(f"when {t} then {r}" for t, r in sampling.RATES.items()) + " end"
    wanted = f"wanted as (select tier, case when {rate} >= 1 then n else greatest(1, floor(n * {rate})) end as want from (select tier, count(*) as n from tiers where label = 0 group by tier))"
    budget = f"budget as (select {sampling.RATIO} * greatest(1, count(*) filter (label = 1)) as budget from tiers)"
    taken = "taken as (select tier, greatest(0, least(want, budget - coalesce(sum(want) over (order by tier rows between unbounded preceding and 1 preceding), 0))) as take from wanted, budget)"
    cut = f"(select *, row_number() over (partition by label, tier order by {_key('rid, gid', sampling.SEED + 1)}, rid, gid) as k from tiers)"
    return oracle.upto("feats", f"select rid, gid, label, tier from {cut} left join taken using (tier) where label = 1 or k <= take", ", ".join([marked, wanted, budget, taken]))


@query(_mined())
def mined_pairs(spark, d):
    return sampling.mine(_tiers(spark, d)).select("rid", "gid", "label", "tier")


@query(oracle.records("select s1_id, entity_id from truth where entity_id not in (select entity_id from pool where source = 'S2')"))
def unmatched_truth(spark, d):
    _, pool, truth = _prepared(spark, d)
    return sampling.unmatched_truth(truth, pool.where("source = 'S2'")).select("s1_id", "entity_id")


@query(oracle.records(f"select entity_id, case when {_key('entity_id')} % 1000 < 200 then 'validation' else 'train' end as split from s1"))
def split_entities(spark, d):
    return sampling.split_entities(_prepared(spark, d)[0].select("entity_id"))


@query(oracle.records(f"select entity_id from s1 order by {_key('entity_id')}, entity_id limit 500"))
def sample_entities(spark, d):
    return sampling.sample_entities(_prepared(spark, d)[0].select("entity_id"), 500)


@query(oracle.upto("ranked", "select rid, gid, source, block_mask, block_count from (select *, row_number() over (partition by rid order by block_count desc, block_mask desc, gid) as k from ranked) where k <= 20"))
def capped_by_blocks(spark, d):
    """The other cap, at 20 pairs: most blocks first, then the heavier weight (here the mask), then the id."""
    return blocking.capped_by_blocks(blocking.merge(blocking.block_pairs(*_prepared(spark, d)[:2])), 20, "block_mask", "block_count")


# Outputs and checks
_LIST = "select entity_id as source1_entity_id, coalesce(ids, '') as {0} from s1 left join (select rid, string_agg(gid, ',' order by gid) as ids from {1} group by rid) m on m.rid = entity_id"


@query(oracle.upto("scored", _LIST.format("matched_entity_ids", "matches"), oracle.accepted(THRESHOLD)))
def matching_output(spark, d):
    matches, _, s1 = _judged(spark, d)
    return id_lists(s1, matches, "matched_entity_ids")


@query(oracle.upto("found", _LIST.format("candidate_entity_ids", "found")))
def candidate_output(spark, d):
    s1, pool, _ = _prepared(spark, d)
    return id_lists(s1, blocking.candidates(s1, pool), "candidate_entity_ids")


@query("select * from (values ('unknown S1 id', 0), ('duplicate S1 row', 0), ('S1 id omitted', 0), ('duplicate matched ids', 0), ('S1 id used as match', 0), ('match id unknown', 0), ('duplicate S1 row in candidates', 0), ('candidate id unknown', 0), ('match not in candidates', 0)) t(kind, n)")
def submission_checks(spark, d):
    scored, s1, pool, _ = _scored(spark, d)
    return checks.problems(id_lists(s1, decision.accepted(scored, BASE), "matched_entity_ids"), id_lists(s1, scored, "candidate_entity_ids"), s1, pool)


# Profiles
_FIELD = """select '{0}' as field, count(*) as n, count(*) filter ({0} is null) as null_count, count(*) filter (trim(coalesce({0}, '')) = '') as empty_or_blank,
  count(distinct coalesce({0}, '')) as n_unique, min(length(coalesce({0}, ''))) as min_len, max(length(coalesce({0}, ''))) as max_len, round(avg(length(coalesce({0}, ''))), 6) as mean_len,
  quantile_cont(length(coalesce({0}, '')), 0.5)::double as median_len, round(quantile_cont(length(coalesce({0}, '')), 0.95), 6) as p95_len from noisy"""


@query(oracle.records(" union all ".join(_FIELD.format(f) for f in profile.FIELDS)))
def profile_fields(spark, d):
    return _round(profile.field_profile(adapters.trade(spark, d)[1]))


_TOKENS = "tokens as (select list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as tokens from documents)"


def _tokens(spark, d):
    return table(spark, d, "documents").select(F.filter(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("tokens"))


@query(f"with {_TOKENS} select sum(len(tokens))::bigint as total_tokens, round(avg(len(tokens)), 6) as mean_tokens, max(len(tokens)) as max_tokens, (select count(distinct t) from (select unnest(tokens) as t from tokens)) as vocab_size from tokens")
def profile_tokens(spark, d):
    return _round(profile.token_profile(_tokens(spark, d)))


for _rare in (False, True):
    query(f"with {_TOKENS} select t as token, count(*) as n from (select unnest(tokens) as t from tokens) group by 1 order by 2 {'' if _rare else 'desc'}, 1 limit 25", "rare_tokens" if _rare else "top_tokens")(lambda spark, d, r=_rare: profile.top_tokens(_tokens(spark, d), rare=r))


@query(oracle.records("select split_part(entity_id, '-', 1) as prefix, count(*) as n, count(*) - count(distinct entity_id) as duplicate_ids from pool group by 1"))
def profile_prefix(spark, d):
    return profile.id_profile(adapters.trade(spark, d)[1])


@query(oracle.records("select country, count(*) as n from pool group by country order by n desc, country limit 30"))
def profile_countries(spark, d):
    return profile.country_distribution(_prepared(spark, d)[1])


@query(oracle.records("select trim(coalesce(business_name, '')) = '' as name_missing, trim(coalesce(business_address, '')) = '' as address_missing, trim(coalesce(country, '')) = '' as country_missing, count(*) as n from noisy group by 1, 2, 3"))
def profile_missing_combo(spark, d):
    return profile.missing_combinations(adapters.trade(spark, d)[1])


@query(oracle.records("select count(*) filter (regexp_matches(business_name, '[^\\x00-\\x7F]')) as unicode_rows, count(*) filter (regexp_matches(business_name, '[^\\p{L}\\p{N}\\s]')) as punctuation_rows from noisy"))
def profile_characters(spark, d):
    return profile.character_profile(adapters.trade(spark, d)[1])


@query(oracle.rich_query("select sum(len(numbers))::bigint as numeric_token_total, count(*) filter (len(postals) > 0) as records_with_postal_like from pool"))
def profile_address_numbers(spark, d):
    raw = adapters.directory(spark, d)[1]
    return profile.address_numbers(raw.select(rich_text.numbers(F.col("business_address")).alias("numbers"), rich_text.postal_candidates(F.col("business_address")).alias("postals")))


_LISTS = "lists as (select s1.entity_id as source1_entity_id, list(truth.entity_id) filter (truth.entity_id is not null) as ids from s1 left join truth on truth.s1_id = s1.entity_id group by 1)"


def _lists(spark, d):
    s1, _, truth = adapters.trade(spark, d)
    joined = id_lists(s1, truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")), "matched_entity_ids")
    return joined.select("source1_entity_id", rich_text.match_list(F.col("matched_entity_ids")).alias("ids"))


@query(oracle.records(f""", {_LISTS} select count(*) as n_rows, count(distinct source1_entity_id) as n_unique_s1, count(*) - count(distinct source1_entity_id) as duplicate_s1_rows,
  count(*) filter (len(coalesce(ids, [])) = 0) as n_singletons, count(*) filter (len(ids) >= 2) as n_multi_match_entities, sum(len(ids))::bigint as positive_match_ids_total,
  sum(len(list_filter(ids, lambda x: starts_with(x, 'S2-'))))::bigint as s2_positive_count, sum(len(list_filter(ids, lambda x: starts_with(x, 'S3-'))))::bigint as s3_positive_count from lists"""))
def truth_profile(spark, d):
    return profile.truth_profile(_lists(spark, d))


@query(oracle.records(f", {_LISTS} select len(coalesce(ids, [])) as matches, count(*) as n from lists group by 1"))
def match_count_distribution(spark, d):
    return profile.match_count_distribution(_lists(spark, d))


# Rich views and retrieval
@query(oracle.rich_query("select entity_id, name, name_heavy, name_core, addr, addr_heavy, country, house, array_to_string(list_sort(name_grams), '|') as name_grams, array_to_string(list_sort(addr_grams), '|') as addr_grams, array_to_string(list_sort(postals), '|') as postals from pool"))
def rich_views(spark, d):
    joined = lambda c: F.array_join(F.array_sort(c), "|").alias(c)
    return _rich(spark, d)[1].select("entity_id", "name", "name_heavy", "name_core", "addr", "addr_heavy", "country", "house", joined("name_grams"), joined("addr_grams"), joined("postals"))


@query()
def folded_texts(spark, d):
    """Folding needs Unicode tables that SQL lacks; tests hold it against the standard library."""
    return table(spark, d, "documents").select("doc_id", rich_text.clean_folded(rich_text.fold(F.col("text"))).alias("clean"))


def _names_idf(s1, pool):
    everyone = pool.select("name", "name_tokens").union(s1.select("name", "name_tokens"))
    return retrieval.idf(retrieval.document_frequency(everyone, "name_tokens"), retrieval.non_empty(everyone, "name"))


@query(oracle.rich_query("select term, df, round(idf, 6) as idf from freq", oracle.EVERYONE, oracle.frequency("name_tokens", "name")))
def token_df(spark, d):
    s1, pool, _ = _rich(spark, d)
    return _round(_names_idf(s1, pool))


@query(oracle.rare_token("core_tokens", "name", "name_tokens", True))
def rare_name_block(spark, d):
    s1, pool, _ = _rich(spark, d)
    return _round(retrieval.rare_token(s1, pool, _names_idf(s1, pool), "core_tokens", "name_tokens", True))


@query(oracle.rare_token("addr_tokens", "addr", "addr_tokens", False))
def rare_addr_block(spark, d):
    s1, pool, _ = _rich(spark, d)
    everyone = pool.select("addr", "addr_tokens").union(s1.select("addr", "addr_tokens"))
    return _round(retrieval.rare_token(s1, pool, retrieval.idf(retrieval.document_frequency(everyone, "addr_tokens"), retrieval.non_empty(everyone, "addr")), "addr_tokens", "addr_tokens", False))


for _column, _name in (("name_grams", "ngram_block"), ("addr_grams", "addr_ngram_block")):
    query(oracle.gram_overlap(_column), _name)(lambda spark, d, c=_column: _round(retrieval.gram_overlap(*_rich(spark, d)[:2], c)))

_OVERLAP = f"select rid, gid, source, count(*) / max(n) as overlap from (select entity_id as rid, len(list_distinct(core_tokens)) as n, unnest(list_distinct(core_tokens)) as term from s1) join posts using (term) where length(term) >= {retrieval.SHORTEST} group by rid, gid, source"


@query(oracle.rich_query(oracle.best("overlap", _OVERLAP, "rid, gid, source, round(overlap, 6) as overlap"), oracle.postings("name_tokens", retrieval.TOKEN_POSTINGS)))
def token_overlap_block(spark, d):
    return _round(retrieval.token_overlap(*_rich(spark, d)[:2]))


@query(oracle.rich_query("""select rid, gid, source, round(sum(coalesce(freq.idf, 1.0)), 6) as idf_overlap from (select s.entity_id as rid, c.entity_id as gid, c.source, unnest(list_intersect(list_distinct(s.core_tokens), list_distinct(c.core_tokens))) as term from truth join s1 s on s.entity_id = truth.s1_id join pool c on c.entity_id = truth.entity_id)
  left join freq using (term) group by rid, gid, source""", oracle.EVERYONE, oracle.frequency("name_tokens", "name")))  # fmt: skip
def idf_overlap(spark, d):
    s1, pool, truth = _rich(spark, d)
    pairs = truth.join(pool.select("entity_id", "source"), "entity_id").select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid"), "source")
    return _round(retrieval.idf_overlap(pairs, s1, pool, _names_idf(s1, pool)).where("idf_overlap > 0"))


def _rich_exact(columns: list[str], country: bool) -> str:
    some, same = " and ".join(f"{c} <> ''" for c in columns), " and (s.country = '' or s.country = c.country)" if country else ""
    return oracle.rich_query(f"select s.entity_id as rid, c.entity_id as gid, c.source from s1 s join (select *, row_number() over (partition by {', '.join(columns)} order by entity_id) as k from pool where {some}) c using ({', '.join(columns)}) where k <= {retrieval.TOP}{same}")


for _name, _columns, _country in (("rich_exact_name", ["name"], True), ("rich_exact_heavy", ["name_heavy"], True), ("rich_core_name", ["name_core"], True), ("rich_exact_address", ["addr"], False), ("rich_name_house", ["name", "house"], False)):
    query(_rich_exact(_columns, _country), _name)(lambda spark, d, c=_columns, s=_country: retrieval.exact(*_rich(spark, d)[:2], c, s))


#: The blocks that SQL can state: all but the two that compare names by token sets.
_STATED = {name: bit for name, bit in retrieval.BITS.items() if name not in ("postal_name", "country_approx")}


def _stated_blocks() -> dict[str, str]:
    return {
        "exact_name": _rich_exact(["name"], True), "exact_name_heavy": _rich_exact(["name_heavy"], True), "core_name": _rich_exact(["name_core"], True), "exact_address": _rich_exact(["addr"], False),
        "name_housenumber": _rich_exact(["name", "house"], False), "rare_name_token": oracle.rare_token("core_tokens", "name", "name_tokens", True), "rare_addr_token": oracle.rare_token("addr_tokens", "addr", "addr_tokens", False),
        "char_ngram": oracle.gram_overlap("name_grams"), "addr_ngram": oracle.gram_overlap("addr_grams"), "token_overlap": SQL["token_overlap_block"],
    }


def _stated_masks() -> str:
    parts = " union all ".join(f"select rid, gid, source, {_STATED[name]} as bit from ({sql})" for name, sql in _stated_blocks().items())
    return f"select rid, gid, source, bit_or(bit) as blocks, count(*) as n_blocks from ({parts}) group by rid, gid, source"


@query(_stated_masks())
def rich_masks(spark, d):
    """The merged masks of the ten blocks that SQL can state."""
    return retrieval.merged_blocks(*_rich(spark, d)[:2], list(_STATED))[0].select("rid", "gid", "source", "blocks", F.col("n_blocks").cast("long").alias("n_blocks"))


_BLOCK_ROWS = " union all ".join(f"select '{n}' as block, {b} as bit" for n, b in _STATED.items())


@query(oracle.rich_query(f"""select block, sum(n)::bigint as pairs, sum(hits)::bigint as positives, round(sum(hits) / greatest((select count(*) from (select distinct s1_id, entity_id from truth)), 1), 6) as recall,
    round(avg(n), 6) as mean, round(quantile_cont(n, 0.95), 6) as p95, round(quantile_cont(n, 0.99), 6) as p99
  from (select block, s1.entity_id, count(m.rid) as n, count(t.s1_id) as hits from s1 cross join ({_BLOCK_ROWS}) b left join ({_stated_masks()}) m on m.rid = s1.entity_id and m.blocks & b.bit <> 0
    left join (select distinct s1_id, entity_id from truth) t on t.s1_id = m.rid and t.entity_id = m.gid group by block, s1.entity_id) group by block"""))  # fmt: skip
def rich_block_table(spark, d):
    """What each block alone finds and costs."""
    s1, pool, truth = _rich(spark, d)
    return _round(evaluation.block_table(retrieval.merged_blocks(s1, pool, list(_STATED))[0], truth, s1, _STATED))


_PLAIN = list(oracle.stated_features(_STATED, retrieval.BITS, rich_features.STRONG))
_DOUBLES = {c for c in _PLAIN if c.endswith(("_sim", "_ratio", "_coverage", "_jaccard", "_overlap", "_winkler")) or "freq_log" in c}


@query(oracle.rich_features(_stated_blocks(), _STATED, retrieval.BITS, rich_features.STRONG, _DOUBLES))
def rich_features_plain(spark, d):
    """The 79 features but for the ratio family and its products, on the pairs of the ten blocks that SQL can state."""
    s1, pool, _ = _rich(spark, d)
    merged, names = retrieval.merged_blocks(s1, pool, list(_STATED))
    found = _keep(retrieval.idf_overlap(merged, s1, pool, names), anew=False)[0]
    return _round(rich_features.rich_features(found, s1, pool).select("rid", "gid", "source", *_PLAIN))


@query()
def rich_block_table12(spark, d):
    """The same for all twelve blocks, of which SQL lacks the two that compare names."""
    s1, pool, truth = _rich(spark, d)
    return _round(evaluation.block_table(retrieval.rich_candidates(s1, pool), truth, s1, retrieval.BITS))


@query()
def rich_postal_name(spark, d):
    return retrieval.postal_name(*_rich(spark, d)[:2])


@query()
def rich_country_approx(spark, d):
    return retrieval.country_approx(*_rich(spark, d)[:2])


@query()
def rich_candidates(spark, d):
    return _round(retrieval.rich_candidates(*_rich(spark, d)[:2]))


@query()
def rich_features79(spark, d):
    s1, pool, _ = _rich(spark, d)
    return _round(rich_features.rich_features(*_keep(retrieval.rich_candidates(s1, pool), anew=False), s1, pool))


@query()
def ratio_features(spark, d):
    """The ratio family on the production candidates' names: no SQL has it; tests hold it against definitions."""
    s1, pool, _ = _prepared(spark, d)
    pairs = features.joined(blocking.candidates(s1, pool), s1, pool, ["name"])
    return _round(pairs.select("rid", "gid", ratios(F.col("s_name"), F.col("c_name")).alias("r")).select("rid", "gid", "r.*"))


@query()
def gbt_scores(spark, d):
    s1, pool, truth = adapters.trade(spark, d)
    left, right, found = prepared = tuple(_keep(*lifecycle.prepared_candidates(s1, pool)))  # read by training and by the scores
    featured = _keep(features.pair_features(found, left, right), anew=False)[0]
    trained = lifecycle.train(s1, pool, truth, prepared=prepared, featured=featured)
    return _round(model.score(trained.model, featured), 4)


@query()
def calibrated_scores(spark, d):
    scored, s1, _, truth = _scored(spark, d)
    rows = sampling.labelled(scored, truth).persist()
    kind, fitted, _ = model.best_calibrator(rows, truth, s1)
    return _round(model.calibrate(kind, fitted, rows).select("rid", "gid", "source", "p").withColumn("calibrator", F.lit(kind)), 4)


# Experiments, stores, synthetic lists
_VARIANTS = {"A conservative": {"threshold": 0.9}, "B balanced": {"threshold": THRESHOLD}, "C adaptive": {"threshold": 0.75}, "D best validation": {"threshold": THRESHOLD}, "E top only": {"threshold": THRESHOLD, "top_only": True}}


def _variant_sql(name: str, options: dict) -> str:
    inner = oracle.upto("scored", f"select '{name}' as variant, round(avg(f05), 6) as macro_f05 from scores", f"{oracle.accepted(**options)}, {oracle.JUDGED}, {oracle.SCORES}")
    return f"select * from ({inner})"


@query(" union all ".join(_variant_sql(n, o) for n, o in _VARIANTS.items()))
def variants(spark, d):
    scored, s1, _, truth = _scored(spark, d)
    return _round(experiments.variants(scored, truth, s1, BASE))


@query(oracle.records("select s.entity_id as rid, c.entity_id as gid from s1 s join (select *, row_number() over (partition by name_core, country order by entity_id) as k from pool where name_core <> '') c using (name_core, country) where k <= 200"))
def index_lookup(spark, d):
    """The stored index's look-up by core name and country, for all clean records at once."""
    s1, pool, _ = _prepared(spark, d)
    order = Window.partitionBy("name_core", "country").orderBy("entity_id")
    right = pool.where("name_core <> ''").withColumn("k", F.row_number().over(order)).where("k <= 200").select("name_core", "country", F.col("entity_id").alias("gid"))
    return s1.select("name_core", "country", F.col("entity_id").alias("rid")).join(right, ["name_core", "country"]).select("rid", "gid")


@query()
def synthetic_matching(spark, d):
    """The synthetic lists, one clean record for each customer, through blocking, the rule score and the decision."""
    s1, pool, _ = synthetic.synthetic(spark, table(spark, d, "customer").count())
    return id_lists(s1, decision.accepted(lifecycle.rule_scores(s1, pool), BASE), "matched_entity_ids")
