"""Queries of grids, boxes, polygons and raster cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import space as P
from .base import query

#: A square with a hole, a triangle, and a square that shares an edge with the first.
SHAPES = [
    ("AA", "north", [[[-60.0, 0.0], [40.0, 0.0], [40.0, 60.0], [-60.0, 60.0]], [[-20.0, 20.0], [10.0, 20.0], [10.0, 40.0], [-20.0, 40.0]]]),
    ("BB", "south", [[[60.0, -70.0], [150.0, -20.0], [20.0, -10.0]]]),
    ("CC", "north", [[[40.0, 0.0], [100.0, 0.0], [100.0, 60.0], [40.0, 60.0]]]),
]
EDGES = [(c, a[0], a[1], b[0], b[1]) for c, _, rings in SHAPES for r in rings for a, b in zip(r, r[1:] + r[:1])]
EDGE_SQL = "edge(code, x1, y1, x2, y2) as (values " + ", ".join(f"('{c}', {a}::double, {b}::double, {d}::double, {e}::double)" for c, a, b, d, e in EDGES) + ")"
INSIDE = f"""
, {EDGE_SQL},
pt as (select record_id, lon, lat, medium, source_row from obs where lon is not null),
tst as (select record_id, source_row, code, sum(case when (y1 > lat) <> (y2 > lat) and lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1) then 1 else 0 end) % 2 = 1
  or bool_or(abs((lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)) < 1e-12 and lon between least(x1, x2) and greatest(x1, x2) and lat between least(y1, y2) and greatest(y1, y2)) as hit
  from pt cross join edge group by record_id, source_row, lon, lat, code),
held as (select record_id, source_row, code from tst where hit)
"""


def shapes(t):
    return t.spark.createDataFrame(SHAPES, "code string, macroregion string, rings array<array<array<double>>>")


@query("f4_bbox_filter", "select record_id from obs where (lon >= 150 or lon <= -30) and lat between -45 and 30")
def f4(t):
    return P.bbox_filter(t.obs, (150.0, -45.0, -30.0, 30.0)).select("record_id")


BOXES = """select o_orderkey as id, cast(o_custkey * 7919 % 360 - 180 as double) as west, cast(o_custkey * 104729 % 170 - 90 as double) as south,
 cast((o_custkey * 7919 % 360 + o_orderkey % 15) % 360 - 180 as double) as east, cast(o_custkey * 104729 % 170 - 90 + o_orderkey % 9 as double) as north from {orders}"""


REGIONS = """select n_nationkey as id, cast(n_nationkey * 47 % 360 - 180 as double) as west, cast(n_nationkey * 31 % 150 - 90 as double) as south,
 cast((n_nationkey * 47 + 20) % 360 - 180 as double) as east, cast(n_nationkey * 31 % 150 - 78 as double) as north from {nation}"""


@query(
    "f5_bbox_intersects",
    f"""
, b as ({BOXES}), n as ({REGIONS}), s as (select id, south, north, unnest(case when west <= east then [{{'w': west, 'e': east}}] else [{{'w': west, 'e': 180.0::double}}, {{'w': -180.0::double, 'e': east}}] end) as x from b),
m as (select id, south, north, unnest(case when west <= east then [{{'w': west, 'e': east}}] else [{{'w': west, 'e': 180.0::double}}, {{'w': -180.0::double, 'e': east}}] end) as x from n)
select distinct a.id as a_id, c.id as b_id from s a join m c on a.x.w <= c.x.e and c.x.w <= a.x.e and a.south <= c.north and c.south <= a.north""",
)
def f5(t):
    return P.bbox_intersects(t.sql(BOXES), t.sql(REGIONS))


@query("f6_point_in_polygon", INSIDE + "select record_id, code from held")
def f6(t):
    return P.point_in_polygon(t.obs, shapes(t).select("code", "rings")).distinct()


@query("f7_region_filter", INSIDE + "select record_id from pt where lon between -50 and 90 and lat between -60 and 50 and record_id in (select record_id from held)")
def f7(t):
    return P.region_filter(t.obs, (-50.0, -60.0, 90.0, 50.0), shapes(t).select("code", "rings")).select("record_id")


@query(
    "f8_domain_scope_filter",
    INSIDE
    + """
, d as (select record_id, min(sqrt(power(ax + tt * (bx - ax), 2) + power(ay + tt * (by_ - ay), 2))) as m from (
  select *, least(1, greatest(0, case when power(bx - ax, 2) + power(by_ - ay, 2) > 0 then -(ax * (bx - ax) + ay * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)) else 0 end)) as tt from (
  select record_id, (x1 - lon) * cos(radians(lat)) * 111320 as ax, (y1 - lat) * 111320 as ay, (x2 - lon) * cos(radians(lat)) * 111320 as bx, (y2 - lat) * 111320 as by_ from pt cross join edge where medium = 'water')) group by 1)
select record_id, 'inside' as how from pt where medium <> 'water' and record_id in (select record_id from held)
union all select pt.record_id, 'near' from pt join d using (record_id) where medium = 'water' and m <= 300000 and record_id not in (select record_id from held)""",
)
def f8(t):
    df = t.obs.dropDuplicates(["record_id"]).withColumn("domain", F.when(F.col("medium") == "water", "marine").otherwise("land"))
    return P.domain_scope_filter(df, shapes(t).select("code", "rings"), 300.0).select("record_id", "how")


@query("j3_point_to_country", INSIDE + ", m as (select record_id, min(code) as c from held group by 1) select distinct record_id, case when o.lon is null then null else coalesce(c, 'ocean') end as country, case when o.lon is null then null when c is null then 'open ocean' when c = 'BB' then 'south' else 'north' end as macroregion from obs o left join m using (record_id)")
def j3(t):
    return P.point_to_country(t.obs.dropDuplicates(["record_id"]), shapes(t)).select("record_id", "country", "macroregion")


@query(
    "j2_raster_cell_join",
    """
, p as (select distinct record_id, lon, lat, medium, least(719, greatest(0, cast(floor((lon + 180) / 0.5::double) as int))) as c, least(359, greatest(0, cast(floor((lat + 90) / 0.5::double) as int))) as r from obs),
e as (select *, least(((lon + 180) - c * 0.5::double) * cos(radians(lat)) * 111320, (0.5::double - ((lon + 180) - c * 0.5::double)) * cos(radians(lat)) * 111320, ((lat + 90) - r * 0.5::double) * 111320, (0.5::double - ((lat + 90) - r * 0.5::double)) * 111320) as m from p)
select record_id, case when lon is not null and (r * 720 + c) % 11 <> 0 then (r * 7 + c) % 16 end as class_id, case when lon is null then 'no_coordinate' when medium = 'water' then 'not_applicable' when (r * 720 + c) % 11 = 0 then 'no_coverage' when m <= 2000.5 then 'boundary_uncertain' else 'matched' end as raster_status from e""",
)
def j2(t):
    ids = t.spark.range(720 * 360).filter("id % 11 <> 0")
    raster = ids.select(F.floor(F.col("id") / 720).cast("int").alias("row"), (F.col("id") % 720).cast("int").alias("col")).withColumn("class_id", (F.col("row") * 7 + F.col("col")) % 16)
    df = t.obs.dropDuplicates(["record_id"]).withColumns({"domain": F.when(F.col("medium") == "water", "marine").otherwise("land"), "uncertainty_m": F.lit(2000.5)})
    return P.raster_cell_join(df, raster).select("record_id", "class_id", "raster_status")


@query(
    "a8_concentration_grid",
    """select least(35, greatest(0, cast(floor((lon + 180) / 10) as int))) as cell_x, least(17, greatest(0, cast(floor((lat + 90) / 10) as int))) as cell_y, medium, unit, count(*) as records, count(distinct sample_id) as samples,
 count(value) filter (qualifier = 'reported') as quantified, count(*) filter (qualifier <> 'reported') as censored, count(*) filter (qualifier = 'reported' and value is null) as unquantified,
 round(quantile_cont(value, 0.5) filter (qualifier = 'reported'), 4) as median, round(quantile_cont(value, 0.25) filter (qualifier = 'reported'), 4) as q25, round(quantile_cont(value, 0.75) filter (qualifier = 'reported'), 4) as q75
 from obs where element = 'As' and lon is not null group by 1, 2, 3, 4""",
)
def a8(t):
    g = P.concentration_grid(t.obs, "As", 10.0, ["medium", "unit"])
    return g.withColumns({c: F.round(c, 4) for c in ("median", "q25", "q75")})


@query(
    "a22_target_grid",
    f"""
, {EDGE_SQL}, cell as (select cast(k % 24 as int) as i, cast(floor(k / 24) as int) as j, -100 + (k % 24 + 0.5::double) * 10 as lon, -80 + (floor(k / 24) + 0.5::double) * 10 as lat from range(384) s(k)),
tst as (select i, j, code, sum(case when (y1 > lat) <> (y2 > lat) and lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1) then 1 else 0 end) % 2 = 1
  or bool_or(abs((lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)) < 1e-12 and lon between least(x1, x2) and greatest(x1, x2) and lat between least(y1, y2) and greatest(y1, y2)) as hit from cell cross join edge group by i, j, lon, lat, code),
m as (select i, j, min(code) as c from tst where hit group by all),
pl as (select cell.i, cell.j, lon, lat, coalesce(c, 'ocean') as country from cell left join m on cell.i = m.i and cell.j = m.j),
us as (select cast(floor((lon + 100) / 10) as int) as i, cast(floor((lat + 80) / 10) as int) as j, count(*) as records, count(distinct sample_id) as samples from obs where lon >= -100 and lon < 140 and lat >= -80 and lat < 80 group by 1, 2)
select concat(j, ':', i) as cell, country, concat(case country {" ".join(f"when '{c}' then '{m}'" for c, m, _ in SHAPES)} else 'open ocean' end, ':', cast(floor(j * 2 / 16) as int), '-', cast(floor(i * 3 / 24) as int)) as zone,
 cast(floor((row_number() over (partition by country order by lon, lat) - 1) * 4 / count(*) over (partition by country)) as int) as band, coalesce(records, 0) as records, coalesce(samples, 0) as samples from pl left join us using (i, j)""",
)
def a22(t):
    box = (-100.0, -80.0, 140.0, 80.0)
    return P.filled_grid(P.target_grid(t.spark, box, 10.0, shapes(t)), t.obs, box, 10.0).select("cell", "country", "zone", "band", "records", "samples")


@query(
    "j13_neighbor_count",
    """
, f as (select *, row_number() over () as n from flagged), h as (select * from flagged where direction = 'high' and lon is not null and lat is not null),
p as (select element, medium, count(*) as peers from h group by all),
c as (select f.n, count(*) filter (h.record_id is not null) as neighbours from f left join h on f.element = h.element and f.medium = h.medium and not (f.lon = h.lon and f.lat = h.lat) and abs(f.lon - h.lon) <= 2 and abs(f.lat - h.lat) <= 2 group by f.n)
select record_id, f.element, f.medium, direction, case when lon is not null and lat is not null then neighbours end as neighbours, coalesce(peers, 0) as peers from f join c using (n) left join p on f.element = p.element and f.medium = p.medium""",
)
def j13(t):
    return P.neighbor_count(t.flagged, 2.0).select("record_id", "element", "medium", "direction", "neighbours", "peers")
