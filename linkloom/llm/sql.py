"""DuckDB SQL for the operators that SQL can express."""

from .quality_rules import BOILERPLATE, CUT_OFF, MAX_LOST_PERCENT, MAX_REPEAT_PERCENT, MAX_SYMBOL_PERCENT, MENU_MARKS, MENU_PERCENT, MIN_WORDS

SPACES = r"[\x20\x09-\x0D]"

OP10 = f"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACES}+', ' ', 'g')) as text_sha256 from documents
), g as (
  select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by 1
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
"""

_COUNT = "length({0}) - length(regexp_replace({0}, '{1}', '', 'g'))"
_SYMBOLS, _MENU = _COUNT.format("x", "[#*$%&|<>!]"), _COUNT.format("x", "[|>»•]")
_WORDS = "length(x) - length(replace(x, ' ', '')) + 1"
_FAILS = f"(({_SYMBOLS}) * 100 > ({_WORDS}) * {MAX_SYMBOL_PERCENT} or (({_MENU}) >= {MENU_MARKS} and ({_MENU}) * 100 > ({_WORDS}) * {MENU_PERCENT}) or regexp_matches(lower(x), '{'|'.join(BOILERPLATE)}') or {' or '.join(f"suffix(rtrim(x, ' '), '{m}')" for m in CUT_OFF)})"

OP9 = f"""
with t as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), s as (
  select r, doc_id, text, list_filter(regexp_split_to_array(text, '{SPACES}+'), lambda x: x <> '') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from t
), wins as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select r, w, unnest(range(1, len(w) - 1)) as i from s)
), again as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from wins) where n > 1
), covered as (
  select r, count(distinct i + k) as n from again, range(3) as o(k) group by r
), c as (
  select s.r, doc_id, len(w) as n_words, length(regexp_replace(text, '{SPACES}', '', 'g')) as word_chars,
    {_COUNT.format("text", "[#*$%&|<>]")} as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
    coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) as chars, coalesce(list_sum(list_transform(list_filter(lines, lambda x: {_FAILS}), lambda x: length(x))), 0) as lost
  from s left join covered on s.r = covered.r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) and 100 * lost <= {MAX_LOST_PERCENT} * chars as kept
from c
"""

ORACLES = {"op9_quality_rules": OP9, "op10_exact_dedup": OP10}
