"""Queries of sampling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as K
from .base import query

ORDER = ["source_row", "record_id"]
UNIQUE = "u as (select distinct on (record_id) * from obs order by record_id, source_row, value)"


def unique(t):
    return t.obs.dropDuplicates(["record_id"])


@query("k1_balanced_cap", f", {UNIQUE}, k as (select record_id, medium, row_number() over (partition by medium order by source_row, record_id) as k from u) select record_id, medium from k where k <= 100")
def k1(t):
    return K.balanced_cap(unique(t), 400, ORDER).select("record_id", "medium")


_GRIDS = (2.0, 10.0, 30.0, None)


def _cell(d):
    if d is None:
        return "'-'"
    return f"case when lon is not null then least({round(180 / d) - 1}, greatest(0, cast(floor((lat + 90) / {d}::double) as int))) * 100000 + least({round(360 / d) - 1}, greatest(0, cast(floor((lon + 180) / {d}::double) as int))) end"


_HASH = "cast('0x' || substr(md5(sample_id || '#5'), 1, 15) as bigint)"
_REPS = " union all ".join(f"select {i} as lvl, arg_min(sample_id, ({_HASH}, sample_id)) as sample_id from obs group by source_id, medium, element, {_cell(d)}" for i, d in enumerate(_GRIDS))


@query("k2_coverage_preserving_sample", f"""
, su as (select sample_id, count(*) as n, {_HASH} as h from obs group by 1), must as (select distinct sample_id from flagged where direction = 'high'),
fo as (select distinct lvl, sample_id from ({_REPS}) union select l.lvl, must.sample_id from must, range({len(_GRIDS)}) l(lvl)),
pick as (select min(lvl) as lvl from (select lvl, sum(n) as n from fo join su using (sample_id) group by 1) where n <= 20000 or lvl = {len(_GRIDS) - 1}),
k as (select su.*, case when fo.sample_id is not null then 0 else 1 end as first from su left join (select fo.sample_id from fo join pick using (lvl)) fo on su.sample_id = fo.sample_id),
r as (select *, sum(n) over (order by first, h, sample_id) as running from k)
select record_id, sample_id from obs where sample_id in (select sample_id from r where first = 0 or running <= 20000)""")
def k2(t):
    return K.coverage_preserving_sample(t.obs, t.flagged.filter("direction = 'high'"), 20000, ["source_id", "medium", "element"], _GRIDS[:-1]).select("record_id", "sample_id")


@query("k3_round_robin_sample", f""", {UNIQUE}, n as (select *, row_number() over (partition by element, medium, source_id order by source_row, record_id) as n from u), p as (select *, row_number() over (partition by element order by case when n > 5 then 1 else 0 end, n, medium, source_id, source_row, record_id) as p from n)
select record_id, element from p where p <= 60""")
def k3(t):
    return K.round_robin_sample(unique(t), "element", ["medium", "source_id"], ORDER, 60, 5).select("record_id", "element")


@query("k4_evenly_spaced_sample", f", {UNIQUE}, p as (select record_id, row_number() over (order by source_row, record_id) as p, count(*) over () as n from u) select record_id from p where p in (select 1 + i * (n - 1) // 49 from range(50) s(i))")
def k4(t):
    return K.evenly_spaced_sample(unique(t), 50, ORDER).select("record_id")


@query("k5_balanced_layer_sample", f""", {UNIQUE}, s as (select least(min(n), 40) as size from (select count(*) as n from u group by sample_type)), a as (select *, row_number() over (partition by sample_type, qualifier = 'lt' order by source_row, record_id) as s1 from u),
b as (select *, row_number() over (partition by sample_type order by case when qualifier = 'lt' and s1 = 1 then 1 else 0 end desc, source_row, record_id) as k from a) select record_id, sample_type from b, s where k <= size""")
def k5(t):
    return K.balanced_layer_sample(unique(t), "sample_type", 40, ORDER, F.col("qualifier") == "lt").select("record_id", "sample_type")


@query("k6_review_sample", f""", {UNIQUE}, p as (select *, row_number() over (order by source_row, record_id) as p, count(*) over () as n from u),
w as (select p, 1 as why from p where p in (select 1 + i * (n - 1) // 4 from range(5) s(i)) union all select min(p), 2 from p group by medium union all select min(p), 3 from p group by qualifier
 union all select arg_min(p, (value, p)), 20 from p where value is not null group by element union all select arg_max(p, (value, -p)), 20 from p where value is not null group by element union all select p, 30 from p where p in (select 1 + i * (n - 1) // 39 from range(40) s(i))),
c as (select p, min(why) as why from w group by p order by 2, 1 limit 40) select record_id, cast(why as int) as why from p join c using (p)""")
def k6(t):
    rows = unique(t).select("record_id", "source_row", "medium", "qualifier", "element", "value")
    return K.review_sample(rows, 40, ORDER, ["medium", "qualifier"], "element", "value").select("record_id", "why")


@query("k7_top_k_per_group", "select element, source_id, n from (select *, row_number() over (partition by element order by n desc, source_id) as k from (select element, source_id, count(*) as n from obs group by 1, 2)) where k <= 2")
def k7(t):
    by = t.obs.groupBy("element", "source_id").agg(F.count("*").alias("n"))
    return K.top_k_per_group(by, ["element"], [F.desc("n"), "source_id"], 2)
