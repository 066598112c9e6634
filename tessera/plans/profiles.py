"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import assign
from tessera.operators import profile as P
from tessera.plans import sqltext as Q
from tessera.plans.linkage import _POSTAL_SQL, _r
from tessera.plans.registry import register
from tessera.sources import tables as S

ENT = f"with {S.ENTITIES_SQL}"
GT = f"{ENT}, {S.TRUTH_SQL}"
TAG = "split_part(entity_id, '-', 1)"


def _both(spark, sf):
    ents = S.entities(spark, sf)
    return ents, S.truth(ents)


@register(f"{ENT}, e as (select *, {TAG} as source from ent) select source, country, count(*) as n, any_value(k) as n_rows, any_value(rep)::BIGINT as repeated from e join (select source, count(*) as k, count(*) - count(distinct entity_id) as rep from e group by all) using (source) group by source, country")
def profile_rows(spark, sf):
    return P.row_counts(S.entities(spark, sf))


@register(f"{ENT} select country, max(({TAG} = 'S1')::INT) as in_s1, max(({TAG} <> 'S1')::INT) as in_noisy from ent group by country")
def profile_countries(spark, sf):
    return P.countries(S.entities(spark, sf))


_CELLS = " union all ".join(f"select {TAG} as source, '{c}' as field, {c} as v from ent" for c in P.FIELDS)


@register(f"""{ENT}, c as ({_CELLS}), k as (select source, field, kind, count(*) filter (case kind when 'empty' then v = '' when 'blank' then trim(v) = '' and v <> '' else contains(v, chr(65533)) end) as n, count(*) as rows
  from c, (values ('empty'), ('blank'), ('broken')) t(kind) group by all) select source, field, kind, n, round(n / rows, 6) as rate from k where n > 0""")
def anomaly_counts(spark, sf):
    return _r(P.anomalies(S.entities(spark, sf)), "rate")


_WORDS = "len(list_filter(string_split(" + Q.squeeze("{0}") + ", ' '), lambda w: w <> ''))"
_LENGTHS = " union all ".join(
    f"select {TAG} as source, country, '{c}_{u}' as field, {e} as v from ent"
    for c in ("business_name", "business_address")
    for u, e in (("chars", f"length({c})"), ("words", _WORDS.replace("{0}", c)))
)


@register(f"""{ENT}, l as ({_LENGTHS}) select source, country, field, min(v)::INT as least, quantile_disc(v, 0.5)::INT as p50, round(avg(v), 6) as mean,
  quantile_disc(v, 0.9)::INT as p90, quantile_disc(v, 0.99)::INT as p99, max(v)::INT as most from l group by all""")
def profile_lengths(spark, sf):
    return _r(P.lengths(S.entities(spark, sf)), "mean")


@register(f"{ENT} select entity_id, length(business_name) as chars, {_WORDS.replace('{0}', 'business_name')} as words from ent")
def token_lengths(spark, sf):
    return S.entities(spark, sf).select(
        "entity_id", F.length("business_name").cast("long").alias("chars"), F.size(X.words(X.squeeze(F.col("business_name")))).cast("long").alias("words")
    )


@register(rf"""{ENT}, c as (select {TAG} as source, country, length(business_name) as n, length(regexp_replace(business_name, '[\x00-\x7F]', '', 'g')) as na,
  len(list_filter(string_split(business_name, ''), lambda x: x <> '' and strip_accents(x) <> x)) as ac, length(regexp_replace(business_name, '[\x00-\x7F\p{{Latin}}\p{{P}}\p{{S}}\p{{Z}}\p{{N}}\p{{C}}]', '', 'g')) as nl from ent)
select source, country, sum(n)::BIGINT as chars, round(coalesce(sum(na) / nullif(sum(n), 0), 0), 6) as non_ascii_share, round(coalesce(sum(ac) / nullif(sum(n), 0), 0), 6) as accented_share,
  round(coalesce(sum(nl) / nullif(sum(n), 0), 0), 6) as non_latin_share from c group by all""")
def script_profile(spark, sf):
    return _r(P.scripts(S.entities(spark, sf)), "non_ascii_share", "accented_share", "non_latin_share")


_PER = f"""{GT}, per as (select source1_entity_id, count(matched_entity_id) as k, count(*) filter (matched_entity_id like 'S2-%') as k2, count(*) filter (matched_entity_id like 'S3-%') as k3 from gt group by all),
pc as (select per.*, country from per join ent on entity_id = source1_entity_id)"""


@register(f"{_PER} select case when grouping(country) = 1 then 'OVERALL' else country end as country, count(*) as n, count(*) filter (k = 0) as singletons, round(count(*) filter (k = 0) / count(*) * 100, 6) as pct from pc group by rollup (country)")
def gt_singletons(spark, sf):
    return _r(P.singletons(*_both(spark, sf)), "pct")


@register(f"""{_PER}, g as (select case when k2 > 0 and k3 > 0 then 'both' when k2 > 0 then 's2_only' when k3 > 0 then 's3_only' else 'singleton' end as kind, count(*) as n from pc group by all)
select kind, n, round(n / sum(n) over () * 100, 6) as pct_all, round(case when kind = 'singleton' then 0 else n / sum(n) filter (kind <> 'singleton') over () * 100 end, 6) as pct_matched from g""")
def gt_overlap(spark, sf):
    return _r(P.overlap(*_both(spark, sf)), "pct_all", "pct_matched")


@register(f"""{_PER}, u as (select 'k' as w, k as matches from pc union all select 'k2', k2 from pc union all select 'k3', k3 from pc)
select matches, count(*) filter (w = 'k') as n_all, count(*) filter (w = 'k2') as n_s2, count(*) filter (w = 'k3') as n_s3 from u group by matches""")
def gt_match_dist(spark, sf):
    return P.match_distribution(*_both(spark, sf))


@register(f"{GT}, o as (select matched_entity_id, count(distinct source1_entity_id) as k from gt where matched_entity_id is not null group by all) select count(*) as matched, count(*) filter (k > 1) as several from o")
def gt_cardinality(spark, sf):
    return P.several_owners(_both(spark, sf)[1])


@register(f"""{GT} select {TAG} as source, country, count(*) as n, count(*) filter (entity_id not in (select matched_entity_id from gt where matched_entity_id is not null)) as orphans,
  round(count(*) filter (entity_id not in (select matched_entity_id from gt where matched_entity_id is not null)) / count(*) * 100, 6) as pct from ent where entity_id not like 'S1-%' group by all""")
def gt_orphans(spark, sf):
    return _r(P.orphans(*_both(spark, sf)), "pct")


@register(f"{GT} select count(*) as pairs, count(*) filter (a.country <> b.country) as mismatches, round(avg((a.country = b.country)::INT) * 100, 6) as pct from gt join ent a on a.entity_id = source1_entity_id join ent b on b.entity_id = matched_entity_id")
def gt_country_consistency(spark, sf):
    return _r(P.country_consistency(*_both(spark, sf)), "pct")


@register(f"""{GT}, m as (select source1_entity_id, matched_entity_id as id, split_part(matched_entity_id, '-', 1) as source, row_number() over (partition by source1_entity_id, split_part(matched_entity_id, '-', 1) order by matched_entity_id) as p from gt where matched_entity_id is not null)
select a.source, a.id as entity_id, b.id as other_id from m a join m b on a.source1_entity_id = b.source1_entity_id and a.source = b.source and b.p between a.p + 1 and a.p + 3""")
def gt_comatch_pairs(spark, sf):
    return P.matched_together(*_both(spark, sf)).select("source", "entity_id", "other_id")


@register(None)
def gt_comatch_sim(spark, sf):
    return P.matched_together_similarity(*_both(spark, sf))


@register(None)
def noise_flags(spark, sf):
    return P.noise_summary(P.true_pairs(*_both(spark, sf)))


_POSTAL_OF = lambda side: _POSTAL_SQL.replace("business_address", f"{side}.business_address").replace("case country", "case l.country")


@register(f"""{GT}, f as (select l.country, split_part(matched_entity_id, '-', 1) as source, lower(trim(l.business_name)) = lower(trim(r.business_name)) as name_exact,
    trim(r.business_address) = '' as addr_missing_in_matched, {_POSTAL_OF('l')} as pa, {_POSTAL_OF('r')} as pb,
    regexp_matches(lower(r.business_address), '(^|{Q.NOT_WORD})({'|'.join(X.LANDMARKS_PROFILE)})({Q.NOT_WORD}|$)') as lm
  from gt join ent l on l.entity_id = source1_entity_id join ent r on r.entity_id = matched_entity_id)
select country, source, count(*) as pairs, round(avg(name_exact::INT) * 100, 6) as name_exact, round(avg(addr_missing_in_matched::INT) * 100, 6) as addr_missing_in_matched,
  round(avg((pa <> '' and pb <> '')::INT) * 100, 6) as addr_has_postal_both, round(avg((pa <> '' and pa = pb)::INT) * 100, 6) as addr_postal_same,
  round(avg((pa <> '' and pb <> '' and pa <> pb)::INT) * 100, 6) as addr_postal_diff, round(avg((pa = '' or pb = '')::INT) * 100, 6) as addr_postal_missing_either,
  round(avg(lm::INT) * 100, 6) as addr_landmark_text from f group by all""")
def noise_flags_plain(spark, sf):
    kept = [n for n in P.NOISE_PLAIN if n not in ("name_match_strip_suffix", "name_subset")]
    return _r(P.noise_summary(P.true_pairs(*_both(spark, sf)), kept), *kept)


@register(rf"""{ENT} select country, count(*) as n, round(avg(({_POSTAL_SQL} <> '')::INT) * 100, 6) as postal_pct,
  round(avg(case when country = 'India' then regexp_matches(trim(business_address), '^[0-9]{{5,6}}({Q.NOT_WORD}|$)') else regexp_matches(trim(business_address), '^[0-9]{{5}}({Q.NOT_WORD}|$)') end::INT) * 100, 6) as starts_with_digits_pct
from ent where entity_id like 'S1-%' group by all""")
def postal_profile(spark, sf):
    return _r(P.postal_profile(S.entities(spark, sf)), "postal_pct", "starts_with_digits_pct")


_SUFFIXES = f"""{ENT}, t as (select country, {Q.runs('lower(business_name)')} as t from ent where entity_id like 'S1-%'), n as (select country, count(*) as names from t group by all),
inv as (select country, suffix, count(*) filter (t[-1] = suffix) as n_trailing, count(*) filter (t[-1] <> suffix) as n_middle from t, (select unnest([{Q.names(X.SUFFIX_INVENTORY)}]) as suffix) where list_contains(t, suffix) group by all)"""


@register(f"""{_SUFFIXES} select country, suffix, n_trailing, round(n_trailing / names * 100, 6) as trailing_pct, n_middle, round(n_middle / names * 100, 6) as middle_pct,
  round(coalesce(n_middle / nullif(n_trailing, 0), 0), 6) as middle_to_trailing from inv join n using (country)""")
def suffix_inventory(spark, sf):
    return _r(P.suffix_inventory(S.entities(spark, sf)), "trailing_pct", "middle_pct", "middle_to_trailing")


@register(f"{_SUFFIXES} select country, suffix, n_trailing, (row_number() over (partition by country order by n_trailing desc, suffix))::INT as place from inv qualify row_number() over (partition by country order by n_trailing desc, suffix) <= 5")
def suffix_top5(spark, sf):
    return P.top_suffixes(S.entities(spark, sf))


_NEG = f"""{GT}, a as (select country, entity_id as s1, row_number() over (partition by country order by md5('42|' || entity_id), entity_id) - 1 as no from ent where entity_id like 'S1-%'),
b as (select country, entity_id as cand, row_number() over (partition by country order by md5('42|' || entity_id), entity_id) - 1 as no from ent where entity_id not like 'S1-%'),
w as (select country, count(*) * 5 as k, (select count(*) from a where a.country = ent.country) as n1, (select count(*) from b where b.country = ent.country) as n2 from gt join ent on entity_id = source1_entity_id where matched_entity_id is not null group by country),
sl as (select country, n1, n2, unnest(range(1, k + 1)) as slot from w),
neg as (select distinct sl.country, s1, cand from sl join a on a.country = sl.country and a.no = ('0x' || substr(md5('a42|' || slot), 1, 8))::BIGINT % n1
  join b on b.country = sl.country and b.no = ('0x' || substr(md5('b42|' || slot), 1, 8))::BIGINT % n2 where (s1, cand) not in (select source1_entity_id, matched_entity_id from gt where matched_entity_id is not null))"""


@register(f"{_NEG} select country, s1, cand from neg")
def random_negatives(spark, sf):
    return P.random_negatives(*_both(spark, sf))


@register(None)
def separability(spark, sf):
    return P.separability(P.pair_similarities(*_both(spark, sf)))


@register(None)
def sim_histogram(spark, sf):
    return P.histogram(P.pair_similarities(*_both(spark, sf)), "name_ratio")


@register(f"""{ENT}, k as (select case when grouping(country) = 1 then 'total' else country end as country, count(*) filter ({TAG} = 'S1') as s1, count(*) filter ({TAG} = 'S2') as s2, count(*) filter ({TAG} = 'S3') as s3 from ent group by rollup (country))
select country, s1, s2, s3, round(s2 / s1, 6) as s2_per_s1, round(s3 / s1, 6) as s3_per_s1, round((s2 + s3) / s1, 6) as noisy_per_s1 from k where s1 > 0""")
def shift_ratios(spark, sf):
    return _r(P.shift_ratios(S.entities(spark, sf)), "s2_per_s1", "s3_per_s1", "noisy_per_s1")


@register(f"""{ENT}, r as (select {Q.runs('lower(business_address)')} as t from ent where country = 'France')
select term, count(*) as n, round(count(*) / (select count(*) from r) * 100, 6) as pct from r, (select unnest([{Q.names(X.STREETS_FRENCH)}]) as term) where list_contains(t, term) group by term order by n desc, term limit 12""")
def street_terms(spark, sf):
    return _r(P.street_terms(S.entities(spark, sf)), "pct")


_FR = r"(0[1-9]|[1-8][0-9]|9[0-8])[0-9]{3}"


@register(rf"""{ENT}, a as (select trim(lower(business_address)) as a from ent where country = 'France'),
k as (select a, regexp_matches(a, '(^|{Q.NOT_WORD}){_FR}({Q.NOT_WORD}|$)') as has, length(regexp_extract(a, '(?s)^(?:(.*{Q.NOT_WORD})|){_FR}(?:{Q.NOT_WORD}|$)', 1)) as start from a),
p as (select case when not has then 'none' when start < 10 then 'near_start' when start + 5 > length(a) - 15 then 'near_end' else 'middle' end as position, count(*) as n from k group by all)
select position, n, round(n / sum(n) over () * 100, 6) as pct from p""")
def postal_position(spark, sf):
    return _r(P.postal_position(S.entities(spark, sf)), "pct")


@register(f"{ENT}, t as (select ({Q.runs('lower(business_name)')})[-1] as suffix from ent where country = 'France') select suffix, count(*) as n from t where suffix in ({Q.names(X.SUFFIXES_FRENCH)}) group by all")
def legal_suffix_top(spark, sf):
    return P.legal_suffixes(S.entities(spark, sf))


_SIDE = "(select count(*) from ent where entity_id like 'S{0}-%' and country {1} 'US')::DOUBLE"


@register(f"""{ENT}, {S.TRUTH_SQL}, us as (select gt.* from gt join ent on entity_id = source1_entity_id where country = 'US'),
b as (select count(*)::DOUBLE as n1, count(*) filter (k = 0) as alone from (select source1_entity_id, count(matched_entity_id) as k from us group by all)),
v as (select *, (select count(*) from us where matched_entity_id like 'S2-%')::DOUBLE as m2, (select count(*) from us where matched_entity_id like 'S3-%')::DOUBLE as m3,
  {_SIDE.format(2, '=')} as k2, {_SIDE.format(3, '=')} as k3, {_SIDE.format(1, '<>')} as t1, {_SIDE.format(2, '<>')} as t2, {_SIDE.format(3, '<>')} as t3 from b)
select 'A' as scenario, round(alone / n1 * 100, 6) as singletons_pct, round((1 - m2 / n1 * t1 / t2) * 100, 6) as s2_orphans_pct, round((1 - m3 / n1 * t1 / t3) * 100, 6) as s3_orphans_pct from v
union all select 'B', round(pow(alone / n1, (m2 / k2 * t2 + m3 / k3 * t3) / t1 / ((m2 + m3) / n1)) * 100, 6), round((1 - m2 / k2) * 100, 6), round((1 - m3 / k3) * 100, 6) from v""")
def rate_scenarios(spark, sf):
    """Known tables: records of the US; target tables: all others."""
    ents = S.entities(spark, sf)
    known, target = ents.where("country = 'US'"), ents.where("country <> 'US'")
    return _r(P.rate_scenarios(known, S.truth(known), target), "singletons_pct", "s2_orphans_pct", "s3_orphans_pct")


@register(f"{ENT} select entity_id, {TAG} as source, business_name from ent where country = 'France' qualify row_number() over (partition by {TAG} order by entity_id) <= case {TAG} when 'S3' then 6 else 7 end")
def sample_records(spark, sf):
    return P.first_rows(S.entities(spark, sf), "France", {"S1": 7, "S2": 7, "S3": 6}).select("entity_id", "source", "business_name")


@register(f"""{ENT} select entity_id from ent qualify row_number() over (partition by {TAG} order by case when {TAG} = 'S1' then entity_id else md5('42|' || entity_id) end, entity_id) <= case {TAG} when 'S1' then 200 else 3000 end""")
def tiny_sample(spark, sf):
    return P.tiny_sample(S.entities(spark, sf)).select("entity_id")


@register(f"""{ENT}, e as (select *, row_number() over (partition by {TAG} order by entity_id) as place from ent) select entity_id, {TAG} as source from e where place % 5 = 0""")
def systematic_sample(spark, sf):
    return assign.systematic_sample(P.with_source(S.entities(spark, sf)).select("entity_id", "source"), 5)


@register(f"""{ENT} select country, count(*) filter ({TAG} = 'S1') as S1, count(*) filter ({TAG} = 'S2') as S2, count(*) filter ({TAG} = 'S3') as S3 from ent group by country""")
def records_pivot(spark, sf):
    return P.records_by_source(S.entities(spark, sf))


@register(f"""{ENT} select l.entity_id as source1_entity_id, r.entity_id as matched_entity_id, l.country as l_country, r.country as r_country
from ent l join ent r on l.business_name = r.business_name and l.country <> r.country where l.entity_id like 'S1-%' and r.entity_id not like 'S1-%'""")
def country_mismatches(spark, sf):
    """Pairs of one name in different countries, as a truth without regard to countries would list them."""
    ents = S.entities(spark, sf)
    same = S.truth(ents.withColumn("country", F.lit("")), every=True)
    return P.country_mismatches(ents, same)
