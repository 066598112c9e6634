"""DuckDB texts of the normalisers and of blocking, for the oracles.

RE2 has no look-around and an ASCII-only word border, so a whole word is matched together with the characters
beside it, which are put back, and the replacement runs twice for words that share one.
"""

from __future__ import annotations

from tessera.functions import text as X
from tessera.operators import block
from tessera.sources.tables import ENTITIES_SQL, TRUTH_SQL

NOT_WORD = r"[^\p{L}\p{N}_]"
PUNCT = r"[^\p{L}\p{N}_\s]"


def literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def names(words: list[str]) -> str:
    return ", ".join(map(literal, words))


def fold(x: str) -> str:
    return f"lower(strip_accents({x}))"


def word_sub(x: str, pattern: str, by: str) -> str:
    for _ in range(2):
        x = rf"regexp_replace({x}, '(^|{NOT_WORD})(?:{pattern})({NOT_WORD}|$)', '\1{by}\2', 'g')"
    return x


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def plain(x: str) -> str:
    return squeeze(f"regexp_replace({x}, '{PUNCT}', ' ', 'g')")


def name(x: str, country: str) -> str:
    c = rf"regexp_replace({x}, '(?i)^\s*(?:{X.HONORIFICS})+', ' ')"
    c = rf"regexp_replace({c}, '(?i)\.(?:{X.DOMAINS})({NOT_WORD}|$)', ' \1', 'g')"
    c = f"replace({fold(c)}, '&', ' and ')"
    c = f"case when lower({country}) = 'france' then {word_sub(c, 'st[.]?', 'saint')} else {c} end"
    return rf"regexp_replace({plain(c)}, '((?: (?:{'|'.join(X.SUFFIXES)})){{1,4}})$', '')"


def name_old(x: str) -> str:
    return plain(word_sub(f"replace({fold(x)}, '&', ' and ')", "|".join(X.SUFFIXES_OLD), " "))


def address(x: str, country: str) -> str:
    c = word_sub(fold(x), r"near|nr|opp|opposite|behind|beside|next\s+to|adjacent\s+to", " ")
    for short, long in X.ABBREVIATIONS.items():
        c = word_sub(c, short, long)
    english = c
    for short, long in X.ABBREVIATIONS_ENGLISH.items():
        english = word_sub(english, short, long)
    return plain(f"case when lower({country}) = 'france' then {word_sub(c, 'st[.]?', 'saint')} else {english} end")


def address_old(x: str) -> str:
    c = f"regexp_replace({fold(x)}, '{PUNCT}', ' ', 'g')"
    for short, long in X.ABBREVIATIONS_OLD.items():
        c = word_sub(c, short, long)
    return squeeze(c)


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def runs(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"


def grams(x: str, n: int = 3) -> str:
    return (
        f"case when length({x}) = 0 then []::VARCHAR[] else "
        f"list_distinct(list_transform(range(1, greatest(length({x}) - {n - 1}, 1) + 1), lambda i: substr({x}, i, {n}))) end"
    )


def jaccard(a: str, b: str, empty: float) -> str:
    shared = f"len(list_intersect({a}, {b}))"
    union = f"(len({a}) + len({b}) - {shared})"
    return f"case when {union} = 0 then {empty} else {shared} / {union} end"


NORM_SQL = f"""{ENTITIES_SQL},
norm as materialized (
  select entity_id, split_part(entity_id, '-', 1) as source, country, business_name, business_address,
    {name("business_name", "country")} as name, {address("business_address", "country")} as address
  from ent)"""


def blocking(how: block.Blocking = block.DEFAULT) -> str:
    """CTEs up to cand: the candidate table of the name and address channels."""
    texts = " union all ".join(
        f"select entity_id, country, source, '{c}' as channel, "
        + {"name": "name", "address": "address", "combo": "trim(name || ' ' || address)"}[c]
        + " as t from norm"
        for c in how.channels
    )
    sims = ", ".join(f"sum(case when channel = '{c}' then a.w * b.w else 0 end) as sim_{c}" for c in how.channels)
    ok = ", ".join(
        f"round(sim_{c}, 9) >= {how.min_sim} and round(sim_{c}, 9) >= {how.rel_floor} * max(round(sim_{c}, 9)) over (partition by s1, pool) as ok_{c}"
        for c in how.channels
    )
    rank = ", ".join(
        f"case when ok_{c} and row_number() over (partition by s1, pool order by ok_{c} desc, round(sim_{c}, 9) desc, cand) <= {how.top_k} "
        f"then row_number() over (partition by s1, pool order by ok_{c} desc, round(sim_{c}, 9) desc, cand) - 1 else {how.no_rank} end as rank_{c}"
        for c in how.channels
    )
    picked = " or ".join(f"rank_{c} < {how.no_rank}" for c in how.channels)
    best = "greatest(" + ", ".join(f"sim_{c}" for c in how.channels) + ")"
    keep = ", ".join([*(f"sim_{c}" for c in how.channels), *(f"rank_{c}" for c in how.channels)])
    return f"""{NORM_SQL},
texts as ({texts}),
tf as materialized (
  select entity_id, country, source, channel, token, count(*) as tf
  from (select entity_id, country, source, channel, unnest({words("t")}) as token from texts) group by all),
pools as (select country, source as pool, count(*) as n from norm where source <> 'S1' group by all),
vocab as materialized (
  select country, pool, channel, token, df, ln((1 + n) / (1 + df)) + 1 as idf
  from (select country, source as pool, channel, token, count(*) as df from tf where source <> 'S1' group by all)
  join pools using (country, pool) where df >= {how.min_df} and df <= {how.max_df} * n),
rawed as (
  select entity_id, country, v.pool, channel, token, tf * idf as raw, source = 'S1' as clean
  from tf join vocab v using (country, channel, token) where source = 'S1' or source = v.pool),
unit as materialized (
  select entity_id, country, pool, channel, token, clean,
    raw / sqrt(sum(raw * raw) over (partition by entity_id, pool, channel)) as w from rawed),
sims as materialized (
  select a.entity_id as s1, a.pool, b.entity_id as cand, {sims}
  from unit a join unit b using (country, pool, channel, token) where a.clean and not b.clean group by all),
floors as (select *, {ok} from sims),
ranked as (select s1, pool, cand, {", ".join(f"sim_{c}" for c in how.channels)}, {rank} from floors),
cand as materialized (
  select s1 as source1_entity_id, cand as candidate_entity_id, {keep}, {best} as sim_best,
    count(*) over (partition by s1) as cand_count, max({best}) over (partition by s1) as sim_max_for_s1,
    max({best}) over (partition by s1) - {best} as sim_margin
  from ranked where {picked})"""


BLOCK_SQL = blocking()
BLOCK_TRUTH_SQL = f"{BLOCK_SQL}, {TRUTH_SQL}"

#: Set features of candidate pairs, and the fixed linear score over them.
SCORED_SQL = f"""{BLOCK_TRUTH_SQL},
rec as materialized (
  select entity_id, name, address, business_name, list_distinct({words("name")}) as nt, list_distinct({words("address")}) as at,
    list_distinct(regexp_extract_all(business_address, '[0-9]+')) as dr from norm),
feat as materialized (
  select c.*, {jaccard("l.nt", "r.nt", 0.0)} as n_jaccard, {jaccard("l.at", "r.at", 0.0)} as a_jaccard,
    {jaccard("l.dr", "r.dr", 0.0)} as digit_jaccard, (len(list_intersect(l.dr, r.dr)) > 0)::INT::DOUBLE as digit_any,
    (l.name = r.name and l.name <> '')::INT::DOUBLE as n_exact, (l.address <> '' and r.address <> '')::INT::DOUBLE as a_both_present,
    case when l.name <> '' and r.name <> '' then least(length(l.name), length(r.name)) / greatest(length(l.name), length(r.name)) else 0.0 end as n_len_ratio,
    (len(list_filter(regexp_extract_all(r.business_name, '\\p{{L}}'), lambda x: unicode(x) >= 2304)) > 0)::INT::DOUBLE as nonlatin_name, (candidate_entity_id like 'S3%')::INT::DOUBLE as is_source3
  from cand c join rec l on l.entity_id = source1_entity_id join rec r on r.entity_id = candidate_entity_id),
scored as materialized (
  select source1_entity_id, candidate_entity_id,
    0.35 * sim_name + 0.25 * sim_address + 0.2 * n_jaccard + 0.1 * n_len_ratio + 0.1 * n_exact as score from feat),
owned as materialized (
  select * from scored
  qualify row_number() over (partition by candidate_entity_id order by round(score, 9) desc, source1_entity_id) = 1)"""


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of texts of at most 125 characters, by bit-parallel rows in one HUGEINT."""
    mask = f"list_sum(list_transform(range(1, length({a}) + 1), lambda i: case when substr({a}, i, 1) = x then 1::HUGEINT << (i - 1)::HUGEINT else 0::HUGEINT end))"
    masks = f"list_transform(string_split({b}, ''), lambda x: coalesce({mask}, 0)::HUGEINT)"
    full = f"((1::HUGEINT << length({a})::HUGEINT) - 1)"
    row = f"list_reduce({masks}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full}::HUGEINT)"
    return f"(case when {a} = '' or {b} = '' then 0 else length({a}) - bit_count({row}) end)"


def ratio_of(found: str, a: str, b: str) -> str:
    return f"case when length({a}) + length({b}) = 0 then 1.0 else 2 * {found} / (length({a}) + length({b})) end"


def edit_measures(pairs: str) -> str:
    """CTEs up to edits: for each row (k, a, b) of ``pairs`` its ratio, token_sort, token_set and partial."""
    listed = lambda x: f"array_to_string(list_sort({x}), ' ')"
    return f"""
cut as materialized (select k, a, b, list_sort({words("a")}) as wa, list_sort({words("b")}) as wb, list_distinct({words("a")}) as sa, list_distinct({words("b")}) as sb from {pairs}),
parts as materialized (select *, array_to_string(wa, ' ') as ta, array_to_string(wb, ' ') as tb, {listed("list_filter(sa, lambda x: not list_contains(sb, x))")} as oa,
  {listed("list_filter(sb, lambda x: not list_contains(sa, x))")} as ob, {listed("list_intersect(sa, sb)")} as common from cut),
windows as materialized (
  select k, short, unnest(list_distinct(list_concat(
    list_transform(range(1, length(short) + 1), lambda n: substr(long, 1, n)), list_transform(range(1, length(short) + 1), lambda n: right(long, n)),
    list_transform(range(1, length(long) - length(short) + 2), lambda i: substr(long, i, length(short)))))) as w
  from (select k, case when length(a) <= length(b) then a else b end as short, case when length(a) <= length(b) then b else a end as long from parts where a <> '' and b <> ''
    union all select k, b, a from parts where a <> '' and length(a) = length(b)) x),
best as (select k, max(2 * {lcs("short", "w")} / (length(short) + length(w))) as partial from windows group by k),
edits as materialized (
  select k, {ratio_of(lcs("a", "b"), "a", "b")} as ratio, {ratio_of(lcs("ta", "tb"), "ta", "tb")} as token_sort,
    case when len(sa) = 0 or len(sb) = 0 then 0.0 when common <> '' and (oa = '' or ob = '') then 1.0
      when common = '' then 2 * {lcs("oa", "ob")} / (length(oa) + length(ob))
      else greatest(2 * (length(common) + 1 + {lcs("oa", "ob")}) / (2 * length(common) + 2 + length(oa) + length(ob)),
        2 * length(common) / (2 * length(common) + 1 + length(oa)), 2 * length(common) / (2 * length(common) + 1 + length(ob))) end as token_set,
    coalesce(partial, (a = b)::INT::DOUBLE) as partial
  from parts left join best using (k))"""
