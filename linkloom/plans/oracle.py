"""DuckDB SQL that the record-linkage queries are compared with, built from the same statements of fact: the adapter's SQL, the
block list, the feature rules. It follows the textbook form (a join for each block, HAVING caps), not the Spark plans."""

from __future__ import annotations

from ..functions import rich_text
from ..functions.text import duck_prepare
from ..operators.blocking import BLOCKS, MAX_CANDIDATES, PREFIX_BLOCKS
from ..operators.features import DIGITS, FEATURES, RULE
from ..operators.retrieval import RARE, SHORTEST, TOP
from ..sources.adapters import CLEAN, DIRECTORY_CLEAN, DIRECTORY_NOISY, DIRECTORY_TRUTH, NOISY, TRUTH

RECORDS = f"""
  clean as ({CLEAN}), noisy as ({NOISY}), truth as ({TRUTH}),
  s1 as ({duck_prepare('clean', 'entity_id')}), pool as ({duck_prepare('noisy', 'entity_id, source')})
"""


def key_tables(blocks=BLOCKS) -> str:
    one = "select {bit} as bit, concat_ws(chr(1), {keys}) as key, count(*) as n, count(*) <= {cap} as kept from pool where {some} group by {keys}"
    return " union all ".join(one.format(bit=b.bit, keys=", ".join(b.keys), cap=b.cap, some=" and ".join(f"{k} <> ''" for k in b.keys)) for b in blocks)


def block_pairs(blocks=BLOCKS) -> str:
    parts = []
    for b in blocks:
        some, keys = " and ".join(f"{k} <> ''" for k in b.keys), ", ".join(b.keys)
        on = " and ".join(f"s.{k} = c.{k}" for k in b.keys)
        gate = f" where s.{b.on} = '' or jaro_winkler_similarity(s.{b.on}, c.{b.on}) >= {b.least}" if b.least else ""
        parts.append(f"select s.entity_id as rid, c.entity_id as gid, c.source, {b.bit} as bit from s1 s join (select {keys} from pool where {some} group by {keys} having count(*) <= {b.cap}) k using ({keys}) join pool c on {on}{gate}")
    return " union all ".join(parts)


def ranked(blocks=BLOCKS) -> str:
    has = ", ".join(f"case when block_mask & {b.bit} <> 0 then 1 else 0 end desc" for b in blocks)
    return f"select *, row_number() over (partition by rid order by {has}, block_count desc, block_mask desc, source, gid) as rn from (select rid, gid, source, bit_or(bit) as block_mask, count(*) as block_count from blocks group by rid, gid, source)"


_SAME = "case when s.{0} <> '' and s.{0} = c.{0} then 1 else 0 end"
_LEV = "1.0 - levenshtein(s.{0}, c.{0})::double / greatest(length(s.{0}), length(c.{0}), 1)"
_COVER = "case when s.{0} = '' or c.{0} = '' then 0.0 else len(list_intersect(string_split(s.{0}, ' '), string_split(c.{0}, ' ')))::double / greatest(list_unique(string_split(s.{0}, ' ')), 1) end"
_LEN = "least(length(s.{0}), length(c.{0}))::double / greatest(length(s.{0}), length(c.{0}), 1)"
_NJ, _AJ = "jaro_winkler_similarity(s.name, c.name)", "jaro_winkler_similarity(s.addr, c.addr)"
EXPRESSIONS = {
    "name_exact": _SAME.format("name"), "name_heavy_exact": _SAME.format("name_heavy"), "name_core_exact": _SAME.format("name_core"), "name_jw": _NJ, "name_jaro": "jaro_similarity(s.name, c.name)",
    "name_lev_ratio": _LEV.format("name"), "name_token_jaccard": _COVER.format("name"), "name_partial": _NJ, "name_len_ratio": _LEN.format("name"), "addr_exact": _SAME.format("addr"), "addr_jw": _AJ,
    "addr_lev_ratio": _LEV.format("addr"), "addr_token_jaccard": _COVER.format("addr"), "addr_len_ratio": _LEN.format("addr"), "house_match": _SAME.format("house"), "postal_match": _SAME.format("postal"),
    "country_equal": _SAME.format("country"), "country_conflict": "case when s.country <> '' and c.country <> '' and s.country <> c.country then 1 else 0 end", "block_count": "block_count", "block_mask": "block_mask",
    "high_name_high_addr": f"case when {_NJ} >= 0.90 and {_AJ} >= 0.85 then 1 else 0 end", "name_addr_product": f"{_NJ} * {_AJ}", "name_present": "case when s.name <> '' then 1 else 0 end",
    "addr_present": "case when s.addr <> '' and s.addr <> ' ' then 1 else 0 end", "source_is_s3": "case when c.source = 'S3' then 1 else 0 end",
}
DOUBLES = {"name_jw", "name_jaro", "name_lev_ratio", "name_token_jaccard", "name_partial", "name_len_ratio", "addr_jw", "addr_lev_ratio", "addr_token_jaccard", "addr_len_ratio", "name_addr_product"}

STEPS = {
    "blocks": lambda: block_pairs(),
    "ranked": lambda: ranked(),
    "found": lambda: f"select rid, gid, source, block_mask, block_count from ranked where rn <= {MAX_CANDIDATES}",
    "feats": lambda: "select rid, gid, c.source, " + ", ".join(f"{EXPRESSIONS[f]} as {f}" for f in FEATURES) + " from found join s1 s on s.entity_id = rid join pool c on c.entity_id = gid",
    "scored": lambda: "select rid, gid, source, round(" + " + ".join(f"{f} * {w}" for f, w in RULE.items()) + f", {DIGITS}) as p from feats",
}


def records(body: str) -> str:
    return f"with {RECORDS} {body}"


def upto(step: str, body: str, more: str = "") -> str:
    """body after the CTEs up to step, and further CTEs (each 'name as (...)', comma-joined)."""
    names = list(STEPS)[: list(STEPS).index(step) + 1]
    return f"with {RECORDS}, " + ", ".join(f"{n} as ({STEPS[n]()})" for n in names) + (f", {more}" if more else "") + f" {body}"


def features(columns: list[str]) -> str:
    return upto("feats", "select rid, gid, source, " + ", ".join(f"round({c}, {DIGITS}) as {c}" if c in DOUBLES else c for c in columns) + " from feats")


def prefix_blocks() -> str:
    return records(f", blocks as ({block_pairs(PREFIX_BLOCKS)}) select rid, gid, source, bit from blocks")


#: Decisions over scored pairs; matches has rid, gid, source, p.
def accepted(threshold: float, s2: float | None = None, s3: float | None = None, margin: float = 0.0, most: int = 0, top_only: bool = False, high: float = 0.995) -> str:
    own = f"case source when 'S2' then {threshold if s2 is None else s2} when 'S3' then {threshold if s3 is None else s3} else {threshold} end"
    rank = "row_number() over (partition by rid order by p desc, gid)"
    if top_only:
        return f"matches as (select rid, gid, source, p from (select *, {rank} as rn from scored) where rn = 1 and (p >= {own} or p >= {high}))"
    parts = [f"passed as (select *, {rank} as rn from scored where p >= {own} or p >= {high})"]
    keep = ["true"]
    if margin:
        parts.append("gaps as (select rid, max(case when rn = 1 then p end) - max(case when rn = 2 then p end) as gap from passed group by rid)")
        keep.append(f"(rn = 1 or not coalesce(gap < {margin}, false))")
    if most:
        keep.append(f"rn <= {most}")
    source = "passed join gaps using (rid)" if margin else "passed"
    return ", ".join([*parts, f"matches as (select rid, gid, source, p from {source} where {' and '.join(keep)})"])


JUDGED = "judged as (select rid, gid, max(pred) as pred, max(truth) as truth, split_part(gid, '-', 1) as source from (select rid, gid, 1 as pred, 0 as truth from matches union all select s1_id, entity_id, 0, 1 from truth) group by rid, gid)"
F_HALF = "case when n_pred = 0 and n_truth = 0 then 1.0 when tp = 0 then 0.0 else 1.25 * (tp / n_pred) * (tp / n_truth) / (0.25 * (tp / n_pred) + tp / n_truth) end"
SCORES = f"scores as (select rid, tp, n_pred - tp as fp, n_truth - tp as fn, n_pred, n_truth, {F_HALF} as f05 from (select s1.entity_id as rid, coalesce(tp, 0) as tp, coalesce(n_pred, 0) as n_pred, coalesce(n_truth, 0) as n_truth from s1 left join (select rid, sum(pred * truth) as tp, sum(pred) as n_pred, sum(truth) as n_truth from judged group by rid) j on j.rid = s1.entity_id))"


# Rich views. The adapter's texts hold ASCII letters and é only, for which lower(strip_accents()) is folding.
def _clean(c: str) -> str:
    out = f"lower(strip_accents(coalesce({c}, '')))"
    for pattern, word in [*rich_text.SIGNS, (r"[^\p{L}\p{N}_\s]", " "), (r"\s+", " ")]:
        out = f"regexp_replace({out}, '{pattern}', '{word}', 'g')"
    return f"trim({out})"


def _words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def _case(t: str, table: dict[str, str]) -> str:
    return f"case {t} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + f" else {t} end"


def _phrases(c: str) -> str:
    out = c
    for pattern, form in rich_text.PHRASES:
        if "(?!" in pattern:  # no look-ahead here: the full form is put aside first
            out = f"replace(regexp_replace(replace({out}, 'pvt ltd', chr(2)), '\\bpvt\\b', chr(2), 'g'), chr(2), 'pvt ltd')"
        else:
            out = f"regexp_replace({out}, '{pattern}', '{form}', 'g')"
    return out


_GRAMS = "case when length({0}) >= 4 then list_distinct(list_transform(range(least(length({0}) - 3, 40)), lambda i: substr({0}, (case when length({0}) - 3 > 40 then floor(i * ((length({0}) - 3) / 40.0))::int else i end) + 1, 4))) when {0} <> '' then [{0}] else []::varchar[] end"
_POSTALS = "list_distinct(list_concat(list_concat(list_filter(numbers, lambda r: length(r) between 5 and 6), regexp_extract_all(coalesce(raw_addr, ''), '\\b([0-9]{5,6}(?:[- ][0-9]{3,4})?)\\b', 1)), list_transform(list_filter(numbers, lambda r: length(r) between 7 and 9), lambda r: left(r, 6))))"


def rich(relation: str, keep: str) -> str:
    legal = ", ".join(f"'{t}'" for t in rich_text.LEGAL_TOKENS)
    steps = f"select {keep}, business_name as raw_name, business_address as raw_addr, {_clean('business_name')} as name, {_clean('business_address')} as addr, {_clean('country')} as clean_country from {relation}"
    heavy_name = f"array_to_string(list_transform({_words(_phrases('name'))}, lambda t: {_case('t', rich_text.NAME_WORDS)}), ' ')"
    short = f"list_transform({_words('addr')}, lambda t: {_case('t', rich_text.ADDRESS_WORDS)})"
    heavy_addr = f"array_to_string(list_transform({short}, lambda t: case when regexp_full_match(t, '[0-9]+') then coalesce(nullif(ltrim(t, '0'), ''), '0') else t end), ' ')"
    tokens = f"{_words('name')} as name_tokens, {_words('addr')} as addr_tokens, regexp_extract_all(coalesce(raw_addr, ''), '[0-9]+') as numbers"
    steps = f"select *, {heavy_name} as name_heavy, {heavy_addr} as addr_heavy, {_case('clean_country', rich_text.COUNTRIES)} as country, {tokens} from ({steps})"
    steps = f"select *, list_filter({_words('name_heavy')}, lambda w: w not in ({legal})) as kept, replace(name_heavy, ' ', '') as name_solid, replace(addr_heavy, ' ', '') as addr_solid from ({steps})"
    core = "list_filter(kept, lambda w, i: i = 1 or kept[i - 1] <> w) as core_tokens"
    grams = f"{_GRAMS.format('name_solid')} as name_grams, {_GRAMS.format('addr_solid')} as addr_grams"
    house = "coalesce(nullif(ltrim(numbers[1], '0'), ''), case when len(numbers) > 0 then '0' else '' end) as house"
    return f"select * exclude (kept, name_solid, addr_solid, numbers), numbers, {core}, {grams}, {_POSTALS} as postals, {house} from ({steps})"


RICH = f"clean as ({DIRECTORY_CLEAN}), noisy as ({DIRECTORY_NOISY}), truth as ({DIRECTORY_TRUTH}), s1 as (select *, array_to_string(core_tokens, ' ') as name_core from ({rich('clean', 'entity_id')})), pool as (select *, array_to_string(core_tokens, ' ') as name_core from ({rich('noisy', 'entity_id, source')}))"
EVERYONE = "everyone as (select name, addr, name_tokens, addr_tokens from s1 union all select name, addr, name_tokens, addr_tokens from pool)"


def frequency(column: str, text: str) -> str:
    """df and idf of the tokens of both lists."""
    return f"freq as (select term, count(*) as df, ln((1.0 + (select count(*) from everyone where {text} <> '')) / (1.0 + count(*))) + 1 as idf from (select unnest(list_distinct({column})) as term from everyone) group by term)"


def postings(column: str, cap: int) -> str:
    return f"posts as (select term, gid, source from (select unnest(list_distinct({column})) as term, entity_id as gid, source from pool) where term in (select term from (select unnest(list_distinct({column})) as term from pool) group by term having count(*) <= {cap}))"


def rich_query(body: str, *more: str) -> str:
    return f"with {RICH}" + "".join(f", {m}" for m in more) + f" {body}"


def best(weight: str, relation: str, columns: str) -> str:
    return f"select {columns}, rank from (select *, row_number() over (partition by rid order by {weight} desc, gid) - 1 as rank from ({relation})) where rank < {TOP}"


def rare_token(column: str, text: str, index_column: str, digits: bool) -> str:
    numbers = "" if digits else " and not regexp_full_match(term, '[0-9]+')"
    shared = f"select rid, gid, source, round(sum(idf), 9) as weight from (select entity_id as rid, unnest(list_distinct({column})) as term from s1) join (select * from freq where length(term) >= {SHORTEST} and df <= {RARE}{numbers}) using (term) join posts using (term) group by rid, gid, source"
    return rich_query(best("weight", shared, "rid, gid, source, round(weight, 6) as weight"), EVERYONE, frequency(index_column, text), postings(index_column, 20000))


def gram_overlap(column: str) -> str:
    shared = f"select rid, gid, source, count(*) as shared, max(n) as n from (select entity_id as rid, len({column}) as n, unnest({column}) as term from s1) join posts using (term) group by rid, gid, source having count(*) >= 2"
    return rich_query(best("shared", shared, "rid, gid, source, shared, round(shared / n, 6) as jaccard"), postings(column, 8000))


# The 79 features without those of the ratio family, stated plainly over pairs, s1 (s) and pool (c).
_BOTH = "(s.{0} <> '' and c.{0} <> '')"
_EQUAL = "(s.{0} <> '' and s.{0} = c.{0})::int"
_RATE = "case when s.{0} <> '' and c.{0} <> '' then least(length(s.{0}), length(c.{0}))::double / greatest(length(s.{0}), length(c.{0})) else 0.0 end"
_SHARE = "case when len(list_distinct(s.{0})) > 0 then len(list_intersect(list_distinct(s.{0}), list_distinct(c.{0})))::double / len(list_distinct(s.{0})) else 0.0 end"
_BEGIN = "case when s.name <> '' and c.name <> '' then len(list_filter(range(1, least(length(s.name), length(c.name)) + 1), lambda i: left({0}, i) = left({1}, i)))::double / greatest(length(s.name), length(c.name)) else 0.0 end"


def _overlap(a: str, b: str) -> str:
    return f"case when len({a}) > 0 and len({b}) > 0 then len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({a}, {b}))) else 0.0 end"


def _numbers(side: str) -> str:
    return f"list_distinct(list_filter({side}.addr_tokens, lambda x: regexp_full_match(x, '[0-9]+')))"


def _digits(side: str) -> str:
    return f"list_distinct(list_filter(string_split({side}.addr, ''), lambda x: regexp_full_match(x, '[0-9]')))"


def _token_at(side: str, k: int) -> str:
    return f"coalesce({side}.addr_tokens[{k}], '')"


def _bits(masks: list[int]) -> str:
    return f"bit_count(blocks & {sum(masks)})"


def stated_features(bits: dict[str, int], all_bits: dict[str, int], strong: list[str]) -> dict[str, str]:
    """Feature -> SQL."""
    first, last = (f"({_token_at('s', k)} <> '' and {_token_at('s', k)} = {_token_at('c', k)})::int" for k in (1, -1))
    return {
        "name_exact": _EQUAL.format("name"),
        "name_heavy_exact": _EQUAL.format("name_heavy"),
        "name_core_exact": _EQUAL.format("name_core"),
        "name_jaro_winkler": "case when s.name <> '' and c.name <> '' then jaro_winkler_similarity(s.name, c.name) else 0.0 end",
        "name_prefix_sim": _BEGIN.format("s.name", "c.name"),
        "name_suffix_sim": _BEGIN.format("reverse(s.name)", "reverse(c.name)"),
        "name_len_diff": "abs(length(s.name) - length(c.name))",
        "name_len_ratio": _RATE.format("name"),
        "name_tok_count_diff": "abs(len(list_distinct(s.name_tokens)) - len(list_distinct(c.name_tokens)))",
        "name_common_tokens": "len(list_intersect(list_distinct(s.name_tokens), list_distinct(c.name_tokens)))",
        "name_token_coverage": _SHARE.format("name_tokens"),
        "name_core_token_coverage": _SHARE.format("core_tokens"),
        "name_ngram_jaccard": "ngram_jaccard",
        "addr_exact": _EQUAL.format("addr"),
        "addr_heavy_exact": _EQUAL.format("addr_heavy"),
        "addr_token_coverage": _SHARE.format("addr_tokens"),
        "addr_len_diff": "abs(length(s.addr) - length(c.addr))",
        "addr_len_ratio": _RATE.format("addr"),
        "addr_num_overlap": _overlap(_numbers("s"), _numbers("c")),
        "house_number_match": _EQUAL.format("house"),
        "postal_match": "list_has_any(s.postals, c.postals)::int",
        "addr_digit_overlap": _overlap(_digits("s"), _digits("c")),
        "addr_first_token_match": first,
        "addr_last_token_match": last,
        "addr_completeness_agree": "((s.addr = '') = (c.addr = ''))::int",
        "addr_missing_s1": "(s.addr = '')::int",
        "addr_missing_cand": "(c.addr = '')::int",
        "name_present_both": f"{_BOTH.format('name')}::int",
        "addr_present_both": f"{_BOTH.format('addr')}::int",
        "country_equal": _EQUAL.format("country"),
        "country_conflict": "(s.country <> '' and c.country <> '' and s.country <> c.country)::int",
        "country_present_both": f"{_BOTH.format('country')}::int",
        "name_freq_log_s1": "ln(1 + coalesce(fs.n, 0))",
        "name_freq_log_cand": "ln(1 + coalesce(fc.n, 0))",
        "name_is_rare": f"(coalesce(fc.n, 0) between 1 and {RARE})::int",
        "core_name_freq_log_cand": "ln(1 + coalesce(fk.n, 0))",
        "addr_freq_log_cand": "ln(1 + coalesce(fa.n, 0))",
        "rare_name_token_count_s1": "coalesce(rn.n, 0)",
        "rare_addr_token_count_s1": "coalesce(ra.n, 0)",
        "idf_token_overlap": "coalesce(io.total, 0.0)",
        "token_overlap": "token_overlap",
        **{f"retrieved_by_{n}": f"(blocks & {b} <> 0)::int" for n, b in all_bits.items()},
        "number_of_blocks": "bit_count(blocks)",
        "name_retrieval_rank": "name_rank",
        "ngram_retrieval_rank": "ngram_rank",
        "addr_retrieval_rank": "addr_rank",
        "cand_is_s3": "(c.source = 'S3')::int",
        "exact_block_count": _bits([all_bits[n] for n in strong if n != "postal_name"]),
        "strong_block_count": _bits([all_bits[n] for n in strong]),
        "weak_block_count": _bits([b for n, b in all_bits.items() if n not in strong]),
        "block_bitmask": "blocks",
        "block_count": "bit_count(blocks)",
    }


def rich_features(blocks: dict[str, str], bits: dict[str, int], all_bits: dict[str, int], strong: list[str], doubles: set[str]) -> str:
    """blocks: name -> SQL of its pairs, with the ranks and weights that it gives."""
    own = {"token_overlap": ("rank", "1000", "1000", "overlap", "0.0"), "char_ngram": ("1000", "rank", "1000", "0.0", "jaccard"), "addr_ngram": ("1000", "1000", "rank", "0.0", "0.0")}
    names = ["name_rank", "ngram_rank", "addr_rank", "token_overlap", "ngram_jaccard"]
    parts = " union all ".join(
        f"select rid, gid, source, {bits[n]} as bit, " + ", ".join(f"{v} as {c}" for v, c in zip(own.get(n, ("1000", "1000", "1000", "0.0", "0.0")), names, strict=True)) + f" from ({sql})" for n, sql in blocks.items()
    )
    lowest, highest = ", ".join(f"least(min({c}), 1000) as {c}" for c in names[:3]), ", ".join(f"max({c}) as {c}" for c in names[3:])
    shared = "unnest(list_intersect(list_distinct(s.core_tokens), list_distinct(c.core_tokens))) as term"
    rare = "select entity_id, count(*) as n from (select entity_id, unnest(list_distinct({0})) as term from s1) join {1} using (term) where df <= {2}{3} group by entity_id"
    ctes = [
        EVERYONE, frequency("name_tokens", "name"), frequency("addr_tokens", "addr").replace("freq as", "afreq as", 1),
        f"pairs as (select rid, gid, source, bit_or(bit) as blocks, {lowest}, {highest} from ({parts}) group by rid, gid, source)",
        f"io as (select rid, gid, sum(coalesce(idf, 1.0)) as total from (select rid, gid, {shared} from pairs join s1 s on s.entity_id = rid join pool c on c.entity_id = gid) left join freq using (term) group by rid, gid)",
        "names as (select name as v, count(*) as n from everyone where name <> '' group by name)", "addrs as (select addr as v, count(*) as n from everyone where addr <> '' group by addr)",
        "cores as (select name_core as v, count(*) as n from (select name_core from s1 union all select name_core from pool) where name_core <> '' group by name_core)",
        f"rn as ({rare.format('core_tokens', 'freq', RARE, '')})", "ra as (" + rare.format("addr_tokens", "afreq", RARE, " and not regexp_full_match(term, '[0-9]+')") + ")",
    ]
    columns = ", ".join(f"round({sql}, 6) as {n}" if n in doubles else f"{sql} as {n}" for n, sql in stated_features(bits, all_bits, strong).items())
    joins = "join s1 s on s.entity_id = rid join pool c on c.entity_id = gid left join io using (rid, gid) left join names fs on fs.v = s.name left join names fc on fc.v = c.name left join cores fk on fk.v = c.name_core left join addrs fa on fa.v = c.addr left join rn on rn.entity_id = rid left join ra on ra.entity_id = rid"
    return rich_query(f"select rid, gid, pairs.source, {columns} from pairs {joins}", *ctes)
