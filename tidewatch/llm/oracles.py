"""DuckDB SQL of the operators' queries that SQL can express, written from
their contracts and not from the Spark plans."""

from __future__ import annotations

from .quality_rules import ALPHA, DELTA, LEVELS, RULES

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

URL_FILTER = r"""
with p as (
  select page_id, html,
    case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1) else '' end as raw,
    case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
  from pages),
h as (
  select *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from p),
c as (
  select *, case when host <> '' then regexp_replace(host, '^(www|m)\.', '')
      || regexp_replace(path, '(/index)?(\.html?)?/*$', '') end as canon,
    case when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
         when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
         when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
         when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
         when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
  from h),
listed as (
  select distinct canon as l from c
  where canon is not null and 100 * len(regexp_extract_all(html, '[*#$%]{3}')) > length(html))
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
       when l is not null then 'block' else 'allow' end as verdict,
  l is not null as listed
from c left join listed on canon = l
"""

NGRAM_JOIN = rf"""
with recursive d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
  from documents),
s as (
  select distinct r, case when len(w) < 3 then array_to_string(w, ' ')
    else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end as g
  from (select r, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from d where len(w) > 0) x),
n as (select r, count(*) as n from s group by r),
pairs as (
  select a.r as x, b.r as y from s a join s b on a.g = b.g join n nx on nx.r = a.r join n ny on ny.r = b.r
  where 10 * least(nx.n, ny.n) >= 9 * greatest(nx.n, ny.n)
  group by a.r, b.r, nx.n, ny.n having 100 * count(*) >= 90 * (nx.n + ny.n - count(*))),
reach as (
  select r, r as to_r from d
  union
  select reach.r, pairs.y from reach join pairs on reach.to_r = pairs.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(t.doc_id) as component_id
from d join reach on d.r = reach.r join d t on t.r = reach.to_r left join n on n.r = d.r
group by d.r, d.doc_id, n.n
"""

_PER = {"symbols_per_word": "n_symbols / n_words", "shouts_per_word": "n_shouts / n_words", "repeated_share": "n_repeat_words / n_words",
        "dup_line_share": "n_dup_lines / n_lines", "capital_share": "n_capitals / word_chars", "mean_word": "word_chars / n_words"}
_LEVEL = "greatest(" + ", ".join("+".join(f"coalesce(({_PER[r]} > {c})::int, 0)" for c in cuts) for r, cuts in RULES.items()) + ")"

QUALITY_RULES = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(lang, chr(1)) as stratum, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
win as (
  select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as again
  from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3) x),
rep as (select r, count(distinct i + k) as n from win, (select unnest([0, 1, 2]) as k) o where again > 1 group by r),
lin as (
  select r, count(*) as n, count(*) - count(distinct l) as dup
  from (select r, unnest(string_split(t, chr(10))) as l from d) x where regexp_matches(l, '{_WORD}') group by r),
m as (
  select d.r, doc_id, stratum, len(w) as n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(lin.dup, 0) as n_dup_lines,
    coalesce(rep.n, 0) as n_repeat_words, coalesce(lin.n, 0) as n_lines,
    length(t) - length(replace(t, '!', '')) as n_shouts, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals
  from d left join rep on rep.r = d.r left join lin on lin.r = d.r),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {_LEVEL} as level from m),
truth as (select doc_id, min(quality) as quality from labels where quality in (0, 1) group by doc_id),
held as (select stratum, quality, level from v join truth using (doc_id) where not base_failed),
tried as (
  select stratum, cut, count(*) filter (where quality = 1) as n, count(*) filter (where quality = 1 and level >= cut) as x,
    count(*) filter (where quality = 0 and level >= cut) as caught
  from held, (select unnest(range(1, {LEVELS + 1})) as cut) c group by stratum, cut),
tested as (
  select *, case when x >= n * {ALPHA} then 1.0 else list_sum(list_transform(range(0, x + 1),
    lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA})))) end as p
  from tried),
good as (
  select *, min((p * (select count(distinct stratum) from held) <= {DELTA})::int) over (partition by stratum order by cut desc) as ok
  from tested),
best as (
  select stratum, cut from good where ok = 1
  qualify row_number() over (partition by stratum order by caught desc, cut desc) = 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(level >= cut, false) as kept
from v left join best using (stratum)
"""

HARD_NEGATIVES = """
with r as (select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
n as (select p.*, s.other_id as negative_id, s.score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by s.score desc, s.other_id) as rank
  from p join s using (anchor_id) where not s.same and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 5"""
