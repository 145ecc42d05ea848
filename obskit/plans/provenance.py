"""Queries of evidence checks, series and outlier provenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import times
from ..operators import provenance as P
from ..operators import reports as R
from .base import query
from .reports import COARSE, COHORT, coarse
from .standard import FORMATS, TIMES, _formats


def r(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("j4_evidence_reconcile", """
, a as (select record_id, count(*) as na, min(title) as ta, min(license) as la from obs group by 1), b as (select record_id, count(*) as nb, min(title) as tb, min(license) as lb from evidence group by 1),
j as (select coalesce(a.record_id, b.record_id) as record_id, na, nb, ta, la, tb, lb from a full join b on a.record_id = b.record_id)
select record_id, 'missing_evidence' as problem from j where nb is null union all select record_id, 'missing_record' from j where na is null union all select record_id, 'repeated_evidence' from j where nb > 1
union all select record_id, 'conflict_title' from j where na is not null and nb is not null and ta is distinct from tb union all select record_id, 'conflict_license' from j where na is not null and nb is not null and la is distinct from lb""")
def j4(t):
    return P.evidence_reconcile(t.obs, t.evidence, ["title", "license"])


def _sources(t):
    return t.spark.createDataFrame([(f"src-{i}",) for i in range(6)], "source_id string")


@query("j5_evidence_orphans", "select record_id, 'no_evidence' as problem from obs where record_id not in (select record_id from evidence) union all select record_id, 'unknown_source' from evidence where source_id = 'src-9'")
def j5(t):
    return P.evidence_orphans(t.obs, t.evidence, _sources(t))


@query("j6_hash_consistency", "select source_id, source_file, 'several_hashes' as problem from evidence group by 1, 2 having count(distinct file_hash) > 1 union all select distinct source_id, source_file, 'hash_not_in_manifest' from evidence where file_hash not in ('h-src-0','h-src-1','h-src-2','h-src-3','h-src-4','h-src-5')")
def j6(t):
    manifest = t.spark.createDataFrame([(f"h-src-{i}",) for i in range(6)], "file_hash string")
    return P.hash_consistency(t.evidence, manifest)


@query("j7_artifact_coordinate_check", "select distinct record_id, case when source_row % 17 = 0 then 'swapped' else 'differs' end as problem from obs where lon is not null and (source_row % 17 = 0 and abs(lon - lat) > 1e-6 or source_row % 17 = 1)")
def j7(t):
    k = F.col("source_row") % 17
    features = t.obs.select("record_id", F.when(k == 0, F.col("lat")).when(k == 1, F.col("lon") + 300).otherwise(F.col("lon")).alias("lon"), F.when(k == 0, F.col("lon")).otherwise(F.col("lat")).alias("lat"), "source_row")
    o = t.obs.dropDuplicates(["record_id"])
    return P.artifact_coordinate_check(o, features.dropDuplicates(["record_id"]))


@query("j20_source_binding_check", "select source_id, 'title' as field, count(*) as mismatches from obs where source_id <> 'src-0' group by 1 union all select source_id, 'license', count(*) from obs where license is not null and license <> 'lic-0' or license is not null and source_id not in ('src-0','src-1') group by 1")
def j20(t):
    manifest = t.spark.createDataFrame([("src-0", ["title-0"], ["lic-0"]), ("src-1", ["title-9"], ["lic-0"])], "source_id string, title array<string>, license array<string>")
    return P.source_binding_check(t.obs, manifest, ["title", "license"])


@query("j19_expected_count_reconcile", "select source_id, count(*) as observed, case source_id when 'src-0' then cast(1 as bigint) end as expected, case when source_id <> 'src-0' then 'baseline' when count(*) = 1 then 'match' else 'drift' end as status from obs group by 1")
def j19(t):
    return P.expected_count_reconcile(t.obs, t.spark.createDataFrame([("src-0", 1)], "source_id string, expected bigint"))


@query("a56_compact_evidence", """
, e as (select *, min(record_id) over (partition by source_id, file_hash) as f from evidence), c as (select source_id, file_hash, count(distinct title) + max(cast(title is null as int)) <= 1 as ct, count(distinct analyte) + max(cast(analyte is null as int)) <= 1 as ca from evidence group by 1, 2)
select record_id, case when not ct or record_id = f then title end as title, case when not ca or record_id = f then analyte end as analyte, record_id = f as anchor from e join c on e.source_id = c.source_id and e.file_hash = c.file_hash""")
def a56(t):
    return P.compact_evidence(t.evidence, ["source_id", "file_hash"], ["title", "analyte"], "record_id").select("record_id", "title", "analyte", "anchor")


@query("a57_source_manifest", """select o.source_id, coalesce(string_agg(distinct e.title, ';' order by e.title), '') as titles,
 coalesce(string_agg(distinct e.license, ';' order by e.license), '') as licenses,
 coalesce(string_agg(distinct o.doi, ';' order by o.doi), '') as dois,
 coalesce(string_agg(distinct o.version, ';' order by o.version), '') as versions,
 coalesce(string_agg(distinct o.tier, ';' order by o.tier), '') as tiers,
 coalesce(string_agg(distinct o.url, ';' order by o.url), '') as urls,
 coalesce(string_agg(distinct e.source_file || '#' || file_hash || '#' || coalesce(o.url, ''), ';' order by e.source_file || '#' || file_hash || '#' || coalesce(o.url, '')), '') as files,
 coalesce(string_agg(distinct concat_ws(', ', e.title, o.version, o.doi), ';' order by concat_ws(', ', e.title, o.version, o.doi)), '') as citations,
 count(o.lon) as located, count(o.license) as licensed, count(*) filter (o.title = e.title) as verified, count(*) as records from obs o join evidence e using (record_id) group by 1""")
def a57(t):
    return P.source_manifest(t.obs, t.evidence)


@query("a15_station_series", """
, b as (select station, element, unit, count(*) as n, count(distinct t) as points, min(t) as first, max(t) as last from series group by 1, 2, 3),
k as (select *, row_number() over (partition by station, element order by n desc, unit) as k, sum(n) over (partition by station, element) - n as dropped from b)
select station, element, unit, points, cast(dropped as bigint) as dropped, round(first, 6) as first, round(last, 6) as last from k where k = 1 and points >= 3""")
def a15(t):
    return r(P.station_series(t.series), 6, "first", "last")


@query("a15_station_points", """
, u as (select station, element, unit, count(*) as n, count(distinct t) as points from series group by all),
k as (select * from (select *, row_number() over (partition by station, element order by n desc, unit) as k from u) where k = 1 and points >= 3),
p as (select s.station, s.element, s.unit, t, value, row_number() over (partition by s.station, s.element order by t, value) as pos from series s join k on s.station = k.station and s.element = k.element and s.unit = k.unit)
select station, element, unit, cast(floor((pos - 1) / 5) as int) as chunk, count(*) as n, round(min(t), 6) as first, round(max(t), 6) as last, string_agg(cast(round(value * 100) as bigint), ',' order by pos) as hundredths from p group by all""")
def a15_points(t):
    rows = P.station_points(t.series, size=5)
    said = F.array_join(F.transform("points", lambda p: F.round(p["value"] * 100).cast("bigint").cast("string")), ",")
    ends = F.transform("points", lambda p: p["t"])
    return rows.select("station", "element", "unit", "chunk", F.size("points").cast("bigint").alias("n"), F.round(F.array_min(ends), 6).alias("first"), F.round(F.array_max(ends), 6).alias("last"), said.alias("hundredths"))


@query("a16_linear_trend", """
, g as (select element, unit, count(*) as n, regr_slope(value, t) as slope, regr_intercept(value, t) as intercept, max(t) - min(t) as span, median(value) as median from series group by 1, 2)
select element, unit, n, round(slope, 4) as slope, round(span, 6) as span, round(median, 4) as median, case when slope * span > 0.15 * abs(median) then 'rising' when slope * span < -0.15 * abs(median) then 'falling' when slope * span is not null then 'stable' else 'undetermined' end as trend from g""")
def a16(t):
    return r(r(P.linear_trend(t.series, "t", "value", ["element", "unit"]), 4, "slope", "median"), 6, "span").drop("intercept")


#: Without the format of one source, so that its rows are unmapped.
_BASIS = "case source_id " + " ".join(f"when '{k}' then '{v}'" for k, v in FORMATS.items() if k != "src-3") + " end"
_LESS = ", dl as (select * replace (case when source_id = 'src-3' then null else prec end as prec, case when source_id = 'src-3' then case when s is null then 'not_reported' else 'unparseable' end else status end as status) from dated) "


@query("a17_source_time_summary", TIMES + _LESS + f""", g as (select source_id, count(*) as records, count(*) filter (status = 'reported') as dated, count(*) filter (status = 'not_reported') as undated, count(*) filter (status = 'unparseable') as unparseable, {_BASIS} as basis from dl group by source_id)
select *, case when basis is null then 'no_declared_format' when dated = records then 'all_dated' when unparseable > undated then 'does_not_fit_the_format' else 'not_reported' end as reason from g""")
def a17(t):
    formats = _formats(t).filter("source_id <> 'src-3'")
    return P.source_time_summary(times.normalize_sampling_time(t.raw, formats), formats)


@query("a18_dated_summary", TIMES + _LESS + "select status, prec as precision, count(*) as n, count(*) filter (source_id = 'src-3') as unmapped from dl group by 1, 2")
def a18(t):
    formats = _formats(t).filter("source_id <> 'src-3'")
    return P.dated_summary(times.normalize_sampling_time(t.raw, formats), formats)


@query("j14_co_anomaly_elements", "select f.sample_id, (select string_agg(distinct element, ',' order by element) from obs o where o.sample_id = f.sample_id) as measured, string_agg(distinct element, ',' order by element) as flagged_high from flagged f where direction = 'high' group by 1")
def j14(t):
    out = P.co_anomaly_elements(t.obs, t.flagged)
    return out.withColumns({c: F.concat_ws(",", c) for c in ("measured", "flagged_high")})


@query("j15_anomaly_provenance", """
, hi as (select * from flagged where direction = 'high'),
c as (select row_number() over () as n, * from flagged),
near as (select c.n, count(b.record_id) filter (not (b.lon = c.lon and b.lat = c.lat) and abs(b.lat - c.lat) <= 5 and abs(b.lon - c.lon) <= 5) as k, count(b.record_id) as total
  from c left join hi b on b.element = c.element and b.medium = c.medium and b.lon is not null and b.lat is not null where c.lon is not null and c.lat is not null group by c.n),
el as (select sample_id, list(distinct element) as measured from obs group by 1), eh as (select sample_id, list(distinct element) as high from hi group by 1),
d as (select source_id, element, round(lon, 2) as x, round(lat, 2) as y, value as v, cast(substr(sampled_at, 1, 4) as int) + (cast(substr(sampled_at, 6, 2) as int) - 1) / 12.0::double as t from obs where value is not null and sampled_at is not null and lon is not null and lat is not null),
g as (select source_id, element, x, y, regr_slope(v, t) * (max(t) - min(t)) as moved, list_sort(list(v))[cast(floor(count(*) / 2) as bigint) + 1] as med from d group by all having count(*) >= 3 and max(t) > min(t)),
l as (select c.n, record_id, c.direction,
  case when trim(coalesce(lithology, '')) = '' then 'unavailable' when c.element in ('Ni', 'Cr', 'Cu', 'Co', 'V') and regexp_matches(upper(lithology), 'BASALT|GABBRO|DOLERITE|DIABASE|AMPHIBOLITE|GREENSTONE') or c.element in ('As', 'Mo', 'U', 'V', 'Zn') and regexp_matches(upper(lithology), 'SHALE|SCHIST')
    or c.element in ('Ni', 'Cr', 'Co') and regexp_matches(upper(lithology), 'ULTRAMAFIC|PERIDOTITE|SERPENTIN|DUNITE|PYROXENITE|KOMATIITE') then 'supports_geogenic' else 'available_but_neutral' end as lithology_line,
  case when near.n is null then 'unavailable' when k >= 2 then 'supports_geogenic' when k = 0 and total >= 3 then 'supports_anthropogenic' else 'available_but_neutral' end as spatial_line,
  case when len(list_filter(measured, lambda e: e <> c.element)) = 0 or measured is null then 'unavailable'
    when c.element in ('Pb', 'Zn', 'Cd', 'Cu', 'Hg', 'As', 'Sb') and len(list_filter(high, lambda e: e <> c.element and e in ('Pb', 'Zn', 'Cd', 'Cu', 'Hg', 'As', 'Sb'))) > 0 then 'supports_anthropogenic'
    when c.element in ('Ni', 'Cr', 'Co', 'V', 'Cu') and len(list_filter(high, lambda e: e <> c.element and e in ('Ni', 'Cr', 'Co', 'V'))) > 0 then 'supports_geogenic' else 'available_but_neutral' end as association_line,
  case when med is null or med <= 0 then 'unavailable' when moved / med > 0.3 then 'supports_anthropogenic' when moved / med < -0.3 then 'available_but_neutral' else 'supports_geogenic' end as temporal_line
  from c left join near using (n) left join el using (sample_id) left join eh using (sample_id) left join g on g.source_id = c.source_id and g.element = c.element and g.x = round(c.lon, 2) and g.y = round(c.lat, 2)),
s as (select *, len(list_filter([lithology_line, spatial_line, association_line, temporal_line], lambda v: v = 'supports_geogenic')) as ge, len(list_filter([lithology_line, spatial_line, association_line, temporal_line], lambda v: v = 'supports_anthropogenic')) as an from l)
select record_id, case when direction = 'high' then lithology_line end as lithology_line, case when direction = 'high' then spatial_line end as spatial_line, case when direction = 'high' then association_line end as association_line, case when direction = 'high' then temporal_line end as temporal_line,
 case when direction <> 'high' then 'not_applicable_depletion' when ge >= 1 and an >= 1 then 'mixed_or_undistinguished' when ge >= 2 then 'geogenic_background' when an >= 2 then 'suspected_anthropogenic_input' else 'insufficient_evidence' end as class from s""")
def j15(t):
    year = F.substring("sampled_at", 1, 4).cast("int") + (F.substring("sampled_at", 6, 2).cast("int") - 1) / 12.0
    return P.anomaly_provenance(t.obs.withColumn("t", year), t.flagged, 5.0)


@query("j16_cohort_pair_candidates", COARSE + """
, m as (select s.element, s.medium, s.method_family, s.sample_type as s_sample_type, d.sample_type as d_sample_type, s.quantified_samples + d.quantified_samples as score from usable s join usable d on s.element = d.element and s.medium = d.medium and s.method_family = d.method_family
 where (s.medium = 'soil' and s.sample_type = 'topsoil' and d.sample_type in ('subsoil', 'core') or s.medium = 'sediment' and s.sample_type in ('topsoil', 'subsoil') and d.sample_type = 'core')
 and s.west <= d.east and d.west <= s.east and s.south <= d.north and d.south <= s.north)
select * from m qualify row_number() over (partition by element, medium order by score desc, method_family, s_sample_type, d_sample_type) = 1""")
def j16(t):
    return P.cohort_pair_candidates(coarse(t), {"soil": (("topsoil",), ("subsoil", "core")), "sediment": (("topsoil", "subsoil"), ("core",))}, 10)


@query("j17_fraction_pair_candidates", COHORT + """
, k as (select *, case when sample_type = 'topsoil' then 'partial' else 'bulk' end as kind from cohort where sample_type in ('topsoil','subsoil')),
g as (select element, medium, sum(samples) filter (kind = 'bulk') as b, sum(samples) filter (kind = 'partial') as p, min(west) filter (kind = 'bulk') as wb, max(east) filter (kind = 'bulk') as eb, min(south) filter (kind = 'bulk') as sb, max(north) filter (kind = 'bulk') as nb,
 min(west) filter (kind = 'partial') as wp, max(east) filter (kind = 'partial') as ep, min(south) filter (kind = 'partial') as sp, max(north) filter (kind = 'partial') as np from k group by 1, 2)
select element, medium, 'x' as stem, cast(b as bigint) as bulk, cast(p as bigint) as "partial" from g where b > 0 and p > 0 and wb <= ep and wp <= eb and sb <= np and sp <= nb""")
def j17(t):
    named = F.when(F.col("sample_type") == "topsoil", "x_fine").when(F.col("sample_type") == "subsoil", "x_bulk").otherwise(F.col("sample_type"))
    cohorts = R.analysis_cohorts(t.obs).withColumn("sample_type", named)
    return P.fraction_pair_candidates(cohorts, {"_bulk": "bulk", "_fine": "partial"})
