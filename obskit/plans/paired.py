"""Queries of paired and comparative statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import paired as P
from .base import query

PAIR = """
, g as (select source_id, medium, count(*) filter (element = 'As') as nx, count(*) filter (element = 'Zn') as ny, sample_id, max(value) filter (element = 'As') as xv, max(value) filter (element = 'Zn') as yv
  from obs where element in ('As','Zn') and qualifier = 'reported' and value > 0 group by source_id, medium, sample_id),
pr as (select *, case when nx > 1 or ny > 1 then 'ambiguous' when ny = 0 then 'x_only' when nx = 0 then 'y_only' else 'paired' end as status from g)
"""


def _pairs(t):
    return P.element_pair(t.obs, "As", "Zn", ["source_id", "medium", "sample_id"])


def r(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("j9_element_pair", PAIR + "select source_id, medium, sample_id, xv as x_value, yv as y_value, status from pr")
def j9(t):
    return _pairs(t)


@query(
    "a9_element_comparison_stats",
    """
, x as (select medium, source_row, max(value) as xv, max(value * (1 + source_row % 5)) as yv from obs where qualifier = 'reported' and value > 0 group by 1, 2),
p as (select *, log10(xv) as lx, log10(yv) as ly from x),
k as (select *, rank() over (partition by medium order by lx) + (count(*) over (partition by medium, lx) - 1) / 2 as rx, rank() over (partition by medium order by ly) + (count(*) over (partition by medium, ly) - 1) / 2 as ry from p),
m as (select medium, count(*) as n, corr(rx, ry) as rho, median(lx) as mx, median(ly) as my from k group by 1)
select k.medium, any_value(n) as n, round(any_value(rho), 6) as rho, round(any_value(mx), 6) as median_x, round(any_value(my), 6) as median_y, count(*) filter (lx >= mx and ly >= my) as high_high, count(*) filter (lx < mx and ly < my) as low_low,
 count(*) filter (lx >= mx and ly < my) as high_low, count(*) filter (lx < mx and ly >= my) as low_high from k join m on k.medium = m.medium group by 1""",
)
def a9(t):
    rows = t.obs.filter("qualifier = 'reported' and value > 0")
    pairs = rows.groupBy("medium", "source_row").agg(F.max("value").alias("x_value"), F.max(F.col("value") * (1 + F.col("source_row") % 5)).alias("y_value")).withColumn("status", F.lit("paired"))
    return r(P.element_comparison_stats(pairs, ["medium"]), 6, "rho", "median_x", "median_y")


MP = """
, mp as (select sample_id, median(value) filter (method_family = 'xrf') as a, median(value) filter (method_family = 'aas') as b from obs where qualifier = 'reported' and value > 0 and method_family in ('xrf','aas') {w} group by 1 having a is not null and b is not null)
"""


@query("j10_method_pair", MP.format(w="and element = 'As'") + "select sample_id, round(a, 4) as a_median, round(b, 4) as b_median, round(b / a, 6) as ratio from mp")
def j10(t):
    return r(P.method_pair(t.obs, "As", "xrf", "aas"), 4, "a_median", "b_median").withColumn("ratio", F.round("ratio", 6)).drop("log2_ratio")


LP = """
, lp as (select lon as site_lon, lat as site_lat, median(value) filter (sample_type = 'topsoil') as a, median(value) filter (sample_type = 'core') as b from obs where qualifier = 'reported' and value > 0 and lon is not null {w} group by 1, 2 having a is not null and b is not null),
l2 as (select *, b / a as ratio, log2(b / a) as lr from lp)
"""


def _layers(t):
    rows = t.obs.filter("lon is not null").withColumns({"site_lon": F.col("lon"), "site_lat": F.col("lat")})
    return P.median_pair(rows, ["site_lon", "site_lat"], F.col("sample_type"), "topsoil", "core")


@query("j11_layer_pair", LP.format(w="and element = 'As'") + "select round(site_lon, 2) as site_lon, round(site_lat, 2) as site_lat, round(a, 4) as a_median, round(b, 4) as b_median, round(ratio, 6) as ratio, round(lr, 6) as log2_ratio from l2")
def j11(t):
    return r(r(P.layer_pair(t.obs, "As", "topsoil", "core"), 4, "a_median", "b_median"), 6, "ratio", "log2_ratio")


@query(
    "j12_survey_colocation",
    """
, c as (select floor(lon / 4) as cx, floor(lat / 4) as cy, median(value) filter (source_id = 'src-0') as a, median(value) filter (source_id = 'src-1') as b from obs where lon is not null and value > 0 and qualifier = 'reported' and source_id in ('src-0','src-1') group by 1, 2)
select cast(cx as bigint) as cx, cast(cy as bigint) as cy, round(a, 4) as a_median, round(b, 4) as b_median, round(b / a, 6) as ratio, b / a between 0.5 and 2 as agree, a > 500000 and b > 500000 as both_above from c where a is not null and b is not null""",
)
def j12(t):
    o = t.obs
    out = P.survey_colocation(o.filter("source_id = 'src-0'"), o.filter("source_id = 'src-1'"), 4.0, 500000.0)
    return r(r(out, 4, "a_median", "b_median"), 6, "ratio")


#: The same by medium, with a site number to split by.
MEDIA = """
, lp as (select medium, lon as site_lon, lat as site_lat, median(value) filter (sample_type = 'topsoil') as a, median(value) filter (sample_type = 'core') as b from obs
  where qualifier = 'reported' and value > 0 and lon is not null and sample_type in ('topsoil', 'core') group by 1, 2, 3 having a is not null and b is not null),
l2 as (select *, b / a as ratio, log2(b / a) as lr, cast(round(site_lon * 100) as bigint) as site from lp)
"""


def _media_layers(t):
    rows = t.obs.filter("lon is not null").withColumns({"site_lon": F.col("lon"), "site_lat": F.col("lat")})
    pairs = P.median_pair(rows, ["medium", "site_lon", "site_lat"], F.col("sample_type"), "topsoil", "core")
    return pairs.withColumn("site", F.round(F.col("site_lon") * 100).cast("bigint"))


def tail(z: str) -> str:
    """The two-sided normal p value of ``z`` in SQL, by the fit that the operator states."""
    terms = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)
    x, t = f"(abs({z}) / sqrt(2))", f"(1 / (1 + 0.5 * abs({z}) / sqrt(2)))"
    poly = str(terms[0])
    for c in terms[1:]:
        poly = f"({poly} * {t} + {c})"
    return f"least(1.0, {t} * exp(-{x} * {x} + {poly}))"


@query(
    "a46_paired_ratio_test",
    MEDIA
    + f"""
, z as (select *, abs(lr) as m from l2 where lr <> 0), k as (select *, rank() over (partition by medium order by m) + (count(*) over (partition by medium, m) - 1) / 2 as r, count(*) over (partition by medium, m) as tie from z),
w as (select medium, sum(r) filter (lr > 0) as w_plus, count(*)::double as k, sum(tie * tie - 1)::double as ties from k group by 1),
zz as (select medium, w_plus, (w_plus - k * (k + 1) / 4) / sqrt(k * (k + 1) * (2 * k + 1) / 24 - ties / 48) as z from w)
select medium, n, round(mr, 6) as median_ratio, round(sh, 6) as share_above, round(w_plus, 1) as w_plus, round(z, 6) as z, round({tail("z")}, 6) as p_value
from (select medium, count(*) as n, median(ratio) as mr, avg(case when ratio > 1.5 then 1 else 0 end) as sh from l2 group by 1) b join zz using (medium)""",
)
def a46(t):
    return r(r(P.paired_ratio_test(_media_layers(t), ["medium"]), 6, "median_ratio", "share_above", "z", "p_value"), 1, "w_plus").select("medium", "n", "median_ratio", "share_above", "w_plus", "z", "p_value")


@query("a47_bootstrap_median_ci")
def a47(t):
    df = t.obs.filter("qualifier = 'reported' and value > 0").select("element", "medium", F.log10("value").alias("ratio"))
    return P.bootstrap_median_ci(df, ["element", "medium"])


@query(
    "a48_transfer_model",
    MEDIA
    + """
, s as (select *, cast('0x' || substr(md5(cast(site as varchar)), 1, 8) as bigint) % 100 < 80 as fit, log10(a) as lx, log10(b) as ly from l2),
m as (select medium, count(*) as n_train, regr_slope(ly, lx) as slope, regr_intercept(ly, lx) as intercept, regr_r2(ly, lx) as r2, median(ratio) as constant from s where fit group by 1),
q as (select medium, quantile_cont(ratio, 0.75) - quantile_cont(ratio, 0.25) as ratio_iqr from s group by 1),
h as (select medium, count(*) as n_test, median(abs(pow(10, intercept + slope * lx) / b - 1)) as mdape_power, median(abs(a * constant / b - 1)) as mdape_constant from s join m using (medium) where not fit group by 1)
select medium, n_train, round(slope, 6) as slope, round(intercept, 6) as intercept, round(r2, 6) as r2, round(constant, 6) as constant, round(ratio_iqr, 6) as ratio_iqr, n_test, round(mdape_power, 6) as mdape_power, round(mdape_constant, 6) as mdape_constant
from m join q using (medium) left join h using (medium)""",
)
def a48(t):
    out = P.transfer_model(_media_layers(t), ["medium"], "site")
    return r(out, 6, "slope", "intercept", "r2", "constant", "ratio_iqr", "mdape_power", "mdape_constant")


@query(
    "a49_rank_sum_test",
    f"""
, v as (select medium, sample_type, value from obs where sample_type in ('topsoil','core') and qualifier = 'reported' and value > 0),
k as (select *, rank() over (partition by medium order by value) + (count(*) over (partition by medium, value) - 1) / 2 as r, count(*) over (partition by medium, value) as tie from v),
g as (select medium, count(*) filter (sample_type = 'topsoil')::double as na, count(*) filter (sample_type = 'core')::double as nb, sum(r) filter (sample_type = 'topsoil') as ra, sum(tie * tie - 1)::double as ties, median(value) filter (sample_type = 'topsoil') as ma, median(value) filter (sample_type = 'core') as mb from k group by 1),
u as (select *, ra - na * (na + 1) / 2 as u, (ra - na * (na + 1) / 2 - na * nb / 2) / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1)))) as z from g where na >= 30 and nb >= 30)
select medium, cast(na as bigint) as n_a, cast(nb as bigint) as n_b, round(u, 1) as u, round(z, 6) as z, round({tail("z")}, 6) as p_value, round(mb / ma, 6) as median_ratio from u""",
)
def a49(t):
    out = P.rank_sum_test(t.obs, "sample_type", "topsoil", "core", ["medium"])
    return r(r(out, 6, "z", "median_ratio", "p_value"), 1, "u")


@query("a50_depth_profile", "select medium, cast(case when depth < 1 then 0 when depth < 2 then 1 else 2 end as int) as depth_bin, count(*) as n, round(median(value), 4) as median, round(quantile_cont(value, 0.25), 4) as q25, round(quantile_cont(value, 0.75), 4) as q75 from obs where qualifier = 'reported' and value is not null and depth >= 0 and depth < 10 group by 1, 2 having count(*) >= 25")
def a50(t):
    return r(P.depth_profile(t.obs, [0.0, 1.0, 2.0, 10.0], ["medium"]), 4, "median", "q25", "q75")


@query(
    "a51_method_fragmentation",
    """
, b as (select element, case when source_row % 9 = 0 then null else method_family end as mf, count(*) as n from obs group by 1, 2), k as (select *, row_number() over (partition by element order by n desc, mf nulls first) as k from b)
select element, count(mf) as families, round(sum(case when mf is null then n else 0 end) / sum(n), 6) as missing_share, round(max(n) / sum(n), 6) as top_share, string_agg(concat_ws(':', mf, cast(n as varchar)), ',' order by k) filter (k <= 5) as top5 from k group by 1""",
)
def a51(t):
    df = t.obs.withColumn("method_family", F.when(F.col("source_row") % 9 != 0, F.col("method_family")))
    return r(P.method_fragmentation(df, ["element"]), 6, "missing_share", "top_share")


@query("a52_threshold_exceedance", "select source_id, count(*) as n, round(median(value), 4) as median, count(*) filter (value > 200000) as above_200000, count(*) filter (value > 450000) as above_450000 from obs where qualifier = 'reported' and value is not null group by 1")
def a52(t):
    return r(P.threshold_exceedance(t.obs, {"above_200000": 200000.0, "above_450000": 450000.0}), 4, "median")


@query("a53_enriched_bins", LP.format(w="") + "select cast(floor(site_lon / 20) as bigint) as bx, cast(floor(site_lat / 20) as bigint) as \"by\", count(*) as n, round(median(lr), 6) as median_log2 from l2 group by 1, 2 having count(*) >= 5 order by median(lr) desc, 1, 2 limit 8")
def a53(t):
    return r(P.enriched_bins(_layers(t), 20.0), 6, "median_log2")
