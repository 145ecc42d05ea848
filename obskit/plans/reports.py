"""Queries of coverage, completeness and readiness reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardize as S
from ..functions import vocab as V
from ..operators import reports as R
from ..operators import rows
from .base import query
from .standard import ISSUES


def r(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def cell(d):
    return f"least({360 // d - 1}, greatest(0, cast(floor((lon + 180) / {d}) as int)))", f"least({180 // d - 1}, greatest(0, cast(floor((lat + 90) / {d}) as int)))"


X10, Y10 = cell(10)
X1, Y1 = cell(1)


FLAGS = (("CENSORED_VALUE", "qualifier = 'lt'"), ("MISSING_VALUE", "value is null and qualifier <> 'lt'"), ("MISSING_LICENSE", "license is null"), ("INVALID_COORDINATE", "lon is null"), ("MISSING_SOURCE_CRS", "crs is null"))
_ARMS = ", ".join(f"case when {c} then '{n}' end" for n, c in FLAGS)


@query(
    "a10_qc_report",
    f"""
, q as (select *, list_filter([{_ARMS}], lambda x: x is not null) as fl, case when value is null then case when qualifier = 'lt' then 'censored' when basis is null then 'not_reported' else 'invalid_value' end end as mr from obs),
f as (select unnest(fl) as f from q), sev as (select f, case when f in ('MISSING_VALUE', 'INVALID_COORDINATE') then 'error' when f = 'CENSORED_VALUE' then 'info' else 'warning' end as s from f),
c as (select count(*) as records, count(*) filter (value is not null or censor_limit is not null) as standardized, count(*) filter (qualifier <> 'reported') as censored, count(*) filter (len(fl) > 0) as flagged,
 count(*) filter (list_contains(fl, 'MISSING_VALUE') or list_contains(fl, 'INVALID_COORDINATE')) as error_flagged, count(*) filter (lon is not null and lat is not null) as valid_coordinate from q),
u as (unpivot c on records, standardized, censored, flagged, error_flagged, valid_coordinate into name key value n)
select 'count' as section, key, n, round(n / (select records from c), 6) as rate from u
union all select 'flag', f, count(*), null from f group by f union all select 'severity', s, count(*), null from sev group by s union all select 'missing_reason', mr, count(*), null from q where mr is not null group by mr""",
)
def a10(t):
    reason = F.expr("case when value is null then case when qualifier = 'lt' then 'censored' when basis is null then 'not_reported' else 'invalid_value' end end")
    df = t.obs.withColumns({"qc_flags": S.flags(*[(n, F.expr(c)) for n, c in FLAGS]), "missing_reason": reason})
    return R.qc_report(df, V.ERROR_FLAGS, V.INFO_FLAGS)


_PARTS = {"source": 11, "completeness": 7, "method": 5, "spatial": 3, "qc": 2, "overall": 13, "evidence": 17, "usability": 19}


@query(
    "a11_confidence_report",
    f"""
, s as (select {", ".join(f"source_row % {m} / {m - 1}.0::double as {n}" for n, m in _PARTS.items())}, list_filter([case when lon is null then 'no_coordinate' end, case when source_row % 13 < 3 then 'low_cap' end], lambda x: x is not null) as gates from obs),
u as (unpivot s on {", ".join(_PARTS)} into name key value x), v as (select case when key in ('evidence', 'usability') then 'dimension' else 'component' end as section, key, x from u)
select section, key, null as band, count(*) as n, round(avg(x), 6) as mean from v group by 1, 2
union all select 'band', key, case when x >= 0.8 then 'high' when x >= 0.6 then 'medium' else 'low' end, count(*), null from v where section = 'dimension' or key = 'overall' group by 2, 3
union all select 'gate', unnest(gates), null, count(*), null from s group by 2""",
)
def a11(t):
    part = lambda m: (F.col("source_row") % m) / float(m - 1)
    gates = S.flags(("no_coordinate", F.col("lon").isNull()), ("low_cap", F.col("source_row") % 13 < 3))
    df = t.obs.select(F.struct(*[part(m).alias(n) for n, m in _PARTS.items()], gates.alias("gates")).alias("confidence"))
    return r(R.confidence_report(df, ["source", "completeness", "method", "spatial", "qc"], ["evidence", "usability"]), 6, "mean")


_K = "element, medium, sample_type, fraction, basis, method_family, method_scope, unit"


def cohort_sql(keys):
    on = " and ".join(f"co.{k} is not distinct from t.{k}" for k in keys.split(", "))
    return f"""
, b as (select {keys}, source_id, count(*) as n, count(value) as q from obs group by all),
t as (select {keys}, max_by(source_id, (n, source_id)) as top_source, max(n) / sum(n) as top_share, count(*) as sources, max(q) as tq, count(*) filter (q > 0) as qs from b group by all),
co as (select {keys}, count(value) as quantified, count(*) filter (qualifier <> 'reported') as censored, count(*) filter (value is null and qualifier = 'reported') as not_normalized, count(distinct sample_id) as samples,
 count(distinct sample_id) filter (value is not null) as quantified_samples, min(lon) as west, max(lon) as east, min(lat) as south, max(lat) as north, min(sampled_at) as first, max(sampled_at) as last,
 count(*) filter (band = 'high') as high_band, count(*) filter (band = 'medium') as medium_band, count(*) filter (band = 'low') as low_band from obs group by all),
cohort as (select co.*, top_source, top_share, sources, case when quantified_samples >= 20 and quantified >= 0.7 * (quantified + censored + not_normalized) then case when qs >= 2 and tq <= 0.9 * quantified then 'analysis_ready' else 'single_lineage_ready' end
 when quantified_samples >= 8 then 'exploratory_only' else 'insufficient_background' end as tier from co join t on {on})
"""


COHORT = cohort_sql(_K)
#: Cohorts of fewer keys, which are large enough for the rules on pairs and sources at every scale.
COARSE_KEYS = ("element", "medium", "sample_type", "method_family")
COARSE = cohort_sql(", ".join(COARSE_KEYS)) + ", usable as (select * from cohort where tier in ('analysis_ready', 'single_lineage_ready') and quantified_samples >= 10)"
COARSE = COARSE.replace("quantified_samples >= 20", "quantified_samples >= 10").replace("quantified_samples >= 8", "quantified_samples >= 4")


def coarse(t):
    return R.analysis_cohorts(t.obs, COARSE_KEYS, {"samples": 10, "exploratory": 4})


@query("a12_analysis_cohorts", COHORT + "select * replace (round(top_share, 6) as top_share) from cohort")
def a12(t):
    return r(R.analysis_cohorts(t.obs), 6, "top_share")


FIRST = lambda c: f"(list({c} order by source_row, record_id) filter ({c} is not null))[1] as {c}"


@query("a13_sample_context", f"select sample_id, {FIRST('lithology')}, {FIRST('basis')}, {FIRST('license')}, {FIRST('lon')}, {FIRST('lat')}, min(depth) as depth_min, max(depth) as depth_max, min(sampled_at) as first, max(sampled_at) as last, string_agg(distinct element, ',' order by element) as elements, string_agg(distinct source_id, ',' order by source_id) as sources from obs group by 1")
def a13(t):
    out = R.sample_context(t.obs)
    return out.withColumns({c: F.concat_ws(",", c) for c in ("elements", "sources")})


@query("a14_exclusion_counts", "select case when qualifier <> 'reported' then 'censored' when value is null then 'not_standardized' when lon is null then 'no_coordinate' when basis is null then 'no_basis' end as reason, element, medium, count(*) as n from obs where qualifier <> 'reported' or value is null or lon is null or basis is null group by 1, 2, 3")
def a14(t):
    return R.exclusion_counts(t.obs)


@query(
    "a19_database_coverage",
    f"""
, x as (select *, case when lon is not null then concat({Y10}, ':', {X10}) end as cell, license is not null as tr, license is not null and coalesce(url like 'https://%', false) and doi is not null as st from obs),
v as (select 'total' as view, 'all' as key, * from x union all select 'element', element, * from x union all select 'medium', medium, * from x union all select 'pair', element || '|' || medium, * from x
 union all select 'source', source_id, * from x union all select 'lineage', lineage, * from x union all select 'cell', cell, * from x where cell is not null
 union all select 'domain', domain, * from x union all select 'macroregion', macroregion, * from x union all select 'country', country, * from x where country is not null)
select view, key, count(*) as records, count(distinct sample_id) as samples, count(*) filter (tr) as traceable, count(*) filter (st) as strict, count(*) filter (st and lon is not null and value is not null) as ready from v group by 1, 2""",
)
def a19(t):
    return R.database_coverage(t.obs)


@query("a20_spatial_samples", f"select sample_id, {FIRST('lon')}, {FIRST('lat')}, string_agg(distinct element, ',' order by element) as elements, string_agg(distinct medium, ',' order by medium) as media, string_agg(distinct domain, ',' order by domain) as domains from obs group by 1")
def a20(t):
    return R.spatial_samples(t.obs).withColumns({c: F.concat_ws(",", c) for c in ("elements", "media", "domains")})


#: The cells that hold a given table's customers, as a grid of countries by simple rules that both sides can tell.
GRID = """
grid as (select distinct concat(j, ':', i) as cell, -180 + (i + 0.5::double) * 10 as lon, -90 + (j + 0.5::double) * 10 as lat, concat('c', i % 5) as country, concat('z', i // 12, '-', j // 9) as zone, i % 4 as band
 from (select cast(c_custkey % 36 as int) as i, cast(floor(c_custkey / 36) as int) % 18 as j from customer))"""
OCC = f"""
, s as (select sample_id, {FIRST('lon')}, {FIRST('lat')} from obs group by 1), s2 as (select sample_id, concat({Y10}, ':', {X10}) as cell from s where lon is not null),
o as (select 'overall' as view, 'all' as key, sample_id from s2 union select 'element', element, sample_id from obs union select 'medium', medium, sample_id from obs
 union select 'pair', e.element || '|' || m.medium, e.sample_id from (select distinct sample_id, element from obs) e join (select distinct sample_id, medium from obs) m using (sample_id)),
used as (select view, key, cell, count(*) as samples from o join s2 using (sample_id) group by 1, 2, 3), {GRID}
"""


def _grid(t):
    ids = t.customer.select((F.col("c_custkey") % 36).cast("int").alias("i"), (F.floor(F.col("c_custkey") / 36) % 18).cast("int").alias("j")).distinct()
    return ids.select(F.concat_ws(":", "j", "i").alias("cell"), (F.lit(-180) + (F.col("i") + 0.5) * 10).alias("lon"), (F.lit(-90) + (F.col("j") + 0.5) * 10).alias("lat"), F.concat(F.lit("c"), F.col("i") % 5).alias("country"),
                      F.concat(F.lit("z"), F.floor(F.col("i") / 12), F.lit("-"), F.floor(F.col("j") / 9)).alias("zone"), (F.col("i") % 4).alias("band"))


def _used(t):
    return R.occupied_cells(R.spatial_samples(t.obs))


@query("a21_grid_occupancy", OCC + "select view, key, cast(sum(samples) as bigint) as samples, count(*) as cells, count(distinct country) as countries, count(distinct zone) as zones, count(distinct band) as bands from used left join grid using (cell) group by 1, 2")
def a21(t):
    return R.grid_occupancy(_used(t), _grid(t))


_VIEWS = [("overall", "all"), ("element", "As"), ("element", "Xx"), ("medium", "soil"), ("medium", "water"), ("pair", "As|soil"), ("pair", "Hg|water")]
_ASKED = "a(view, key) as (values " + ", ".join(f"('{v}', '{k}')" for v, k in _VIEWS) + ")"


def _views(t):
    return t.spark.createDataFrame(_VIEWS, "view string, key string")


@query(
    "a23_sufficiency_audit",
    OCC
    + f""", {_ASKED}, pl as (select view, key, cast(sum(samples) as bigint) as samples, count(*) as cells from used group by 1, 2), hv as (select distinct view, key, zone, cast(band as varchar) as band from used join grid using (cell)),
m as (select view, key, (select coalesce(string_agg(z, ',' order by z), '') from (select distinct zone as z from grid) zz where not exists (select 1 from hv where hv.view = a.view and hv.key = a.key and hv.zone = z)) as missing_zones,
 (select coalesce(string_agg(b, ',' order by b), '') from (select distinct cast(band as varchar) as b from grid) bb where not exists (select 1 from hv where hv.view = a.view and hv.key = a.key and hv.band = b)) as missing_bands from a),
x as (select m.*, coalesce(samples, 0) as samples, coalesce(cells, 0) as cells from m left join pl using (view, key)),
y as (select *, concat_ws(',', case when samples < 500 then 'too_few_samples' end, case when cells < 400 then 'too_few_cells' end, case when missing_zones <> '' then 'missing_zones' end, case when missing_bands <> '' then 'missing_bands' end) as reasons from x)
select *, case when samples = 0 then 'unassessable' when reasons = '' then 'pass' else 'gap' end as status, samples >= 50 and cells >= 40 as display_pass from y""",
)
def a23(t):
    out = R.sufficiency_audit(_used(t), _grid(t), _views(t), 500, 400, (50, 40))
    return out.withColumns({c: F.concat_ws(",", c) for c in ("reasons", "missing_zones", "missing_bands")})


@query("a24_rank_country_targets", OCC + """, l as (select grid.*, u.cell is not null as ok from grid left join (select distinct cell from used where view = 'pair' and key = 'As|soil') u using (cell)),
g as (select country, count(*) as cells, count(*) filter (not ok) as unfilled, count(distinct zone) - count(distinct zone) filter (ok) as missing_zones, count(distinct band) - count(distinct band) filter (ok) as missing_bands from l group by 1)
select *, cast(row_number() over (order by missing_zones desc, missing_bands desc, unfilled desc, country) as int) as rank from g where unfilled > 0""")
def a24(t):
    return R.rank_country_targets(_used(t).filter("view = 'pair' and key = 'As|soil'"), _grid(t))


@query("a25_country_coverage", OCC + """, g as (select country, count(*) as cells, count(u.cell) as occupied from grid left join (select distinct cell from used) u using (cell) group by 1)
select country, cells, occupied, cast(rank() over (order by cells desc, country) as int) as rank, round(occupied / cells, 6) as share, occupied >= 3 as enough from g""")
def a25(t):
    return r(R.country_coverage(_used(t), _grid(t)), 6, "share")


GAPS = f""", {_ASKED}, z as (select zone, min(lon) as west, min(lat) as south, max(lon) as east, max(lat) as north from grid group by 1), h as (select distinct view, key, zone from used join grid using (cell)),
gap as (select view, key, zone, west, south, east, north from a cross join z where not exists (select 1 from h where h.view = a.view and h.key = a.key and h.zone = z.zone))"""


@query("a26_dimension_gaps", OCC + GAPS + " select * from gap")
def a26(t):
    return R.dimension_gaps(_used(t), _grid(t), _views(t))


@query("a27_field_completeness", "select unnest(['coordinate','license','method','time']) as field, unnest([a, b, c, d]) as filled, unnest([n - a, n - b, n - c, n - d]) as missing, round(unnest([a / n, b / n, c / n, d / n]), 6) as rate from (select count(*) as n, count(*) filter (lon is not null and lat is not null) as a, count(license) as b, count(*) filter (basis is not null and method_family is not null) as c, count(sampled_at) as d from obs)")
def a27(t):
    return r(R.field_completeness(t.obs, {"coordinate": ["lon", "lat"], "license": ["license"], "method": ["basis", "method_family"], "time": ["sampled_at"]}), 6, "rate")


@query("a28_coverage_cube", f"""select source_id, medium, element, sample_type, method_scope, macroregion as region, basis, count(*) as observations, count(distinct sample_id) as samples, count(distinct sample_id) filter (lon is not null) as located_samples,
 count(value) as comparable, count(distinct lineage) as lineages, count(distinct case when lon is not null then {Y1} * 10000 + {X1} end) as cells from obs group by rollup (source_id, medium, element, sample_type, method_scope, macroregion, basis)""")
def a28(t):
    return R.coverage_cube(t.obs.withColumn("region", F.col("macroregion")), totals=True)


_TALLY = lambda c, n: f"(select source_id, string_agg(k || ':' || n, ',' order by k || ':' || n) as {n} from (select source_id, coalesce({c}, 'none') as k, cast(count(*) as varchar) as n from obs group by 1, 2) group by 1)"


@query("a29_source_profile", f"""select source_id, count(*) as records, count(distinct sample_id) as samples, min(lon) as west, max(lon) as east, min(lat) as south, max(lat) as north, count(*) filter (lon is null) as unlocated,
 any_value(regions) as regions, any_value(systems) as systems, any_value(fractions) as fractions, any_value(methods) as methods, any_value(types) as types, any_value(media) as media
from obs join {_TALLY("macroregion", "regions")} using (source_id) join {_TALLY("crs", "systems")} using (source_id) join {_TALLY("fraction", "fractions")} using (source_id) join {_TALLY("method_family", "methods")} using (source_id)
 join {_TALLY("sample_type", "types")} using (source_id) join {_TALLY("medium", "media")} using (source_id) group by 1""")
def a29(t):
    return R.source_profile(t.obs)


@query("a30_medium_balance", f"select medium, element, count(*) as records, count(distinct lineage) as lineages, count(distinct source_id) as sources, count(distinct case when lon is not null then {Y1} * 10000 + {X1} end) as cells from obs group by grouping sets ((medium), (medium, element))")
def a30(t):
    return R.medium_balance(t.obs)


@query("a31_map_availability", """, v as (select 'element' as dimension, element as key, lon, crs from obs union all select 'medium', medium, lon, crs from obs)
select dimension, key, count(lon) as canonical, count(*) filter (lon is null and crs is not null) as reported_only, count(*) filter (lon is null and crs is null) as unplottable from v group by 1, 2""")
def a31(t):
    return R.map_availability(t.obs.withColumn("reported_point", F.col("crs").isNotNull()))


@query(
    "a32_element_distribution",
    """
, v as (select *, log10(value) as lv from obs where qualifier = 'reported' and value > 0), b as (select element, medium, unit, count(*) as n, min(lv) as lo, max(lv) as hi, quantile_cont(value, 0.1) as p10, median(value) as median, quantile_cont(value, 0.9) as p90 from v group by 1, 2, 3),
k as (select * from b qualify row_number() over (partition by element order by n desc, medium, unit) = 1)
select element, medium, unit, n, round(p10, 4) as p10, round(any_value(k.median), 4) as median, round(p90, 4) as p90, case when hi > lo then least(15, cast(floor(round((lv - lo) / (hi - lo) * 16, 9)) as int)) else 0 end as bin, count(*) as in_bin from v join k using (element, medium, unit) group by 1, 2, 3, 4, p10, p90, 8""",
)
def a32(t):
    return r(R.element_distribution(t.obs), 4, "p10", "median", "p90")


@query("a33_coverage_diagnostics", """, v as (select 'medium' as section, medium as key, * from obs union all select 'layer', sample_type, * from obs union all select 'domain', domain, * from obs)
select section, key, count(*) as records, count(distinct sample_id) as samples, round(count(basis) / count(*), 6) as basis_rate, count(*) filter (qualifier <> 'reported') as censored from v group by 1, 2""")
def a33(t):
    return r(R.coverage_diagnostics(t.obs), 6, "basis_rate")


@query("a34_region_presets", """
, x as (select 'pacific' as region, * from obs where (lon >= 150 or lon <= -100) and lat between -60 and 60 union all select 'north' as region, * from obs where lon between -180 and 180 and lat between 30 and 90)
select region, count(*) as records, count(distinct sample_id) as samples, string_agg(distinct element, ',' order by element) as elements, string_agg(distinct medium, ',' order by medium) as media from x group by 1""")
def a34(t):
    return R.region_presets(t.obs, {"pacific": (150.0, -60.0, -100.0, 60.0), "north": (-180.0, 30.0, 180.0, 90.0)})


_BANDS = ", ".join(f"count(*) filter ({c} >= {lo} and {c} < {hi}) as {n}_{b}" for n, c in (("evidence", "(source_row % 11 / 10.0::double)"), ("readiness", "(source_row % 7 / 6.0::double)")) for b, lo, hi in (("high", 0.8, 9), ("medium", 0.6, 0.8), ("low", -1, 0.6)))


@query("a35_source_confidence", f"""
, ab as (select source_id, string_agg(distinct w, ',' order by w) as absent from (select source_id, unnest([case when lon is null then 'no_coordinate' end, case when sampled_at is null then 'no_time' end, case when basis is null then 'no_basis' end, case when license is null then 'no_license' end]) as w from obs) where w is not null group by 1)
select source_id, count(*) as records, round(count(license) / count(*), 6) as license_rate, round(count(lon) / count(*), 6) as coordinate_rate, round(count(basis) / count(*), 6) as basis_rate, round(count(sampled_at) / count(*), 6) as time_rate,
 any_value(absent) as absent, round(avg(source_row % 11 / 10.0::double), 6) as evidence_mean, round(avg(source_row % 7 / 6.0::double), 6) as readiness_mean, {_BANDS},
 case when source_id = 'src-0' then 'https://zero' when source_id = 'src-1' then 'https://one' end as link from obs join ab using (source_id) group by 1""")
def a35(t):
    manifest = t.spark.createDataFrame([("src-0", "https://zero"), ("src-1", "https://one")], "source_id string, link string")
    df = t.obs.withColumns({"evidence": (F.col("source_row") % 11) / 10.0, "readiness": (F.col("source_row") % 7) / 6.0})
    return r(R.source_confidence(df, manifest, ["evidence", "readiness"]), 6, "license_rate", "coordinate_rate", "basis_rate", "time_rate", "evidence_mean", "readiness_mean")


@query("a36_source_independence", """
, p as (select medium, element, count(distinct source_id) as s from obs group by 1, 2), e as (select medium, count(*) filter (s = 1) as single_source, count(*) filter (s > 1) as multi_source from p group by 1),
o as (select medium, count(distinct source_id) as sources, count(distinct lineage) as lineages from obs group by 1)
select medium, sources, lineages, single_source, multi_source, (select coalesce(string_agg(x, ',' order by x), '') from (values ('As'), ('Au'), ('Zn')) q(x) where x not in (select element from obs i where i.medium = o.medium)) as missing,
 case when lineages >= 2 then 'independent' when sources >= 2 then 'shared_lineage' else 'single_source' end as status from o join e using (medium)""")
def a36(t):
    return R.source_independence(t.obs, ["As", "Au", "Zn"])


@query("a37_request_dimension_coverage", "select 'element' as dimension, 'As,Au' as requested, (select string_agg(distinct element, ',') from obs where element in ('As','Au')) as observed, 'Au' as missing union all select 'medium', 'moss,soil', (select string_agg(distinct medium, ',') from obs where medium in ('moss','soil')), 'moss'")
def a37(t):
    return R.request_dimension_coverage(t.obs, {"element": ["Au", "As"], "medium": ["soil", "moss"]})


@query("a38_claim_recompute", """
, c(claim, claimed) as (values ('records', 5), ('sources', 6), ('lies', 1), ('with_coordinates', 7)), a as (select count(*) as records, count(distinct source_id) as sources, count(lon) as wc from obs)
select claim, cast(claimed as bigint) as claimed, case claim when 'records' then records when 'sources' then sources when 'with_coordinates' then wc end as actual,
 case when claim = 'lies' then 'unknown_claim' when claimed = case claim when 'records' then records when 'sources' then sources else wc end then 'match' else 'mismatch' end as status from c, a""")
def a38(t):
    return R.claim_recompute(t.obs, t.spark.createDataFrame([("records", 5), ("sources", 6), ("lies", 1), ("with_coordinates", 7)], "claim string, claimed bigint"))


@query("a39_backlog_summary", ISSUES + " select status, owner, code, count(*) as n from iss group by 1, 2, 3")
def a39(t):
    return R.backlog_summary(rows.row_issues(t.obs))


@query("a43_value_profile", r"""
, c as (select 'value' as element, nullif(trim(value), '') as x from raw union all select 'detection_limit', nullif(trim(detection_limit), '') from raw)
select element, count(try_cast(x as double)) as numeric, count(*) filter (x like '<%') as censored, count(*) filter (x is null) as missing, count(*) filter (x is not null and x not like '<%' and try_cast(x as double) is null) as invalid, min(try_cast(x as double)) as least, max(try_cast(x as double)) as greatest from c group by 1""")
def a43(t):
    return R.value_profile(t.raw, ["value", "detection_limit"])


@query("a44_lab_metadata_profile", "select element, count(*) filter (source_row % 3 = 0) as accredited, count(distinct batch_id) as batches, count(distinct censor_limit) as limits from obs group by 1")
def a44(t):
    return R.lab_metadata_profile(t.obs.withColumn("accredited", F.col("source_row") % 3 == 0))


@query("a43_row_reasons", r"""
, c as (select record_id, [case when nullif(trim(value), '') is null then 'missing' when trim(value) like '<%' then 'censored' when try_cast(trim(value) as double) is null then 'invalid' end,
 case when nullif(trim(detection_limit), '') is null then 'missing' when trim(detection_limit) like '<%' then 'censored' when try_cast(trim(detection_limit) as double) is null then 'invalid' end] as w from raw)
select record_id, array_to_string(list_sort(list_distinct(list_filter(w, lambda x: x is not null))), ',') as reasons from c""")
def a43_rows(t):
    return R.row_reasons(t.raw, ["value", "detection_limit"], "record_id")


@query("a45_quality_flag_audit", "select element, cast(station % 4 as bigint) as flag, count(*) as n, count(distinct station) as stations, count(distinct station % 7) as cruises, min(station % 50 / 2.0::double) as shallowest, max(station % 50 / 2.0::double) as deepest, round(min(t), 6) as first, round(max(t), 6) as last, min(value) as least, max(value) as greatest from series group by 1, 2")
def a45(t):
    s = F.col("station")
    return r(R.quality_flag_audit(t.series.withColumns({"flag": s % 4, "cruise": s % 7, "depth": (s % 50) / 2.0})), 6, "first", "last")


@query("a54_discovery_candidates", COARSE + OCC.replace(" s as (", " sp as (").replace("from s where", "from sp where") + GAPS.replace(" z as (", " zn as (").replace("cross join z ", "cross join zn ").replace("h.zone = z.zone", "h.zone = zn.zone") + """,
m as (select element, sum(quantified_samples) filter (medium = 'soil') as so, coalesce(sum(quantified_samples) filter (medium = 'water'), 0) as wa, coalesce(sum(quantified_samples) filter (medium = 'sediment'), 0) as se from usable group by 1)
select 'T2' as kind, element || '|' || medium || '|' || sample_type as key, cast(sum(quantified_samples) as bigint) as score from usable group by element, medium, sample_type having count(distinct method_family) >= 2
union all select 'T3', element || '|' || medium, sum(quantified_samples) from usable group by element, medium having sum(quantified_samples) >= 30 and count(distinct top_source) = 1 and max(sources) = 1
union all select 'T4', coalesce(zone, 'unknown'), count(*) from gap group by zone
union all select 'T5', element || '|soil|' || case when wa >= 40 then 'water' else 'sediment' end, so + case when wa >= 40 then wa else se end from m where so >= 40 and (wa >= 40 or se >= 40)""")
def a54(t):
    gaps = R.dimension_gaps(_used(t), _grid(t), _views(t)).select(F.col("zone").alias("region"), "key")
    return R.discovery_candidates(coarse(t), gaps, 10, 30, 40)


@query("a55_sampling_priority", COHORT + OCC.replace(" s as (", " sp as (").replace("from s where", "from sp where") + GAPS.replace(" z as (", " zn as (").replace("cross join z ", "cross join zn ").replace("h.zone = z.zone", "h.zone = zn.zone") + f""",
u as (select 1 as kind, 'fill_zone' as task, view || '|' || key || '|' || zone as key, 0 as n from gap union all select 2, 'second_source', concat_ws('|', {_K}), quantified from cohort where sources = 1)
select cast(row_number() over (order by kind, n desc, key) as int) as priority, task, key from u""")
def a55(t):
    return R.sampling_priority(R.dimension_gaps(_used(t), _grid(t), _views(t)), R.analysis_cohorts(t.obs)).drop("box")


@query("a58_readiness_criteria", """
, a as (select count(*)::double as records, count(distinct sample_id)::double as samples, count(distinct source_id)::double as sources, count(license) / count(*) as provenance, count(basis) / count(*) as method, count(lithology) / count(*) as geology, count(lon) / count(*) as mappable from obs),
b as (select 1 - max(n) / sum(n) as source_balance from (select count(*) as n from obs group by source_id)), m as (select min(n) / max(n) as medium_balance, min(l)::double as lineages_per_medium from (select count(*) as n, count(distinct lineage) as l from obs group by medium)),
e as (select min(n) / max(n) as element_balance from (select count(*) as n from obs group by element)),
g as (select sum(case when q >= 8 and q >= 0.7 * n then n else 0 end) / sum(n) as outlier_background from (select count(*) as n, count(*) filter (qualifier = 'reported' and value > 0) as q from obs group by element, medium, unit)),
u as (unpivot (select * from a, b, m, e, g) on columns(*) into name criterion value actual),
t(criterion, least, warn) as (values ('records', 1e9, 100), ('samples', 10, 5), ('sources', 6, 3), ('provenance', 0.99, 0.5), ('method', 0.99, 0.98), ('geology', 0.5, 0.1), ('mappable', 0.9, 0.5), ('source_balance', 0.5, 0.2), ('medium_balance', 0.999, 0.1), ('lineages_per_medium', 2, 1), ('element_balance', 0.9, 0.5), ('outlier_background', 0.9, 0.5), ('nothing', 1, 1))
select criterion, round(actual, 6) as actual, case when actual is null then 'unassessable' when actual >= least then 'pass' when actual >= warn then 'warning' else 'fail' end as status from t left join u using (criterion)""")
def a58(t):
    targets = [("records", 1e9, 100.0), ("samples", 10.0, 5.0), ("sources", 6.0, 3.0), ("provenance", 0.99, 0.5), ("method", 0.99, 0.98), ("geology", 0.5, 0.1), ("mappable", 0.9, 0.5), ("source_balance", 0.5, 0.2), ("medium_balance", 0.999, 0.1), ("lineages_per_medium", 2.0, 1.0), ("element_balance", 0.9, 0.5), ("outlier_background", 0.9, 0.5), ("nothing", 1.0, 1.0)]
    return r(R.readiness_criteria(t.obs, t.spark.createDataFrame(targets, "criterion string, least double, warn double")), 6, "actual")


@query("a59_table_summary", "select string_agg(distinct element, ',' order by element) as elements, string_agg(distinct medium, ',' order by medium) as media, min(lon) as west, max(lon) as east, min(lat) as south, max(lat) as north, round(count(lon) / count(*), 6) as coordinate_rate, round(count(value) / count(*), 6) as standardized_rate from obs")
def a59(t):
    return r(R.table_summary(t.obs), 6, "coordinate_rate", "standardized_rate")


@query("a61_comparability_partitions", "select coalesce(a.medium, b.medium) as medium, coalesce(a.basis, b.basis) as basis, coalesce(a.n, 0) as before, coalesce(b.n, 0) as after from (select medium, measurement_basis as basis, count(*) as n from raw group by 1, 2) a full join (select medium, basis, count(*) as n from obs group by 1, 2) b on a.medium is not distinct from b.medium and a.basis is not distinct from b.basis")
def a61(t):
    return R.comparability_partitions(t.raw, t.obs, ["medium", "measurement_basis"], ["medium", "basis"])
