"""Driver tables as measurement tables, and the register of queries.

The views are plain SQL that Spark and DuckDB read alike, so that an operator's input is the same on both sides and
only the operator differs: DataFrame functions here, independent SQL there.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.screening import robust_anomalies
from ..sources.storage import written

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_ID = "concat(cast(l_orderkey as string),'-',cast(l_linenumber as string),'-',cast(l_partkey as string),'-',cast(l_suppkey as string))"
_ELEMENT = "case l_partkey % 8 when 0 then 'As' when 1 then 'Pb' when 2 then 'Zn' when 3 then 'Cu' when 4 then 'Ni' when 5 then 'Cr' when 6 then 'Cd' else 'Hg' end"

VIEWS = {
    # Standardized measurements.
    "obs": f"""
select {_ID} as record_id, cast(l_orderkey as string) as sample_id, concat('src-', cast(s_nationkey % 6 as string)) as source_id,
 concat('lin-', cast(s_nationkey % 3 as string)) as lineage, {_ELEMENT} as element,
 case l_suppkey % 4 when 0 then 'soil' when 1 then 'rock' when 2 then 'sediment' else 'water' end as medium,
 case l_returnflag when 'A' then 'icp_ms' when 'N' then 'xrf' else 'aas' end as method_family,
 case when l_suppkey % 7 = 0 then cast(null as string) else o_orderpriority end as basis,
 case when l_discount = 0.0 then 'lt' else 'reported' end as qualifier,
 case when l_discount = 0.0 or l_tax = 0.08 then cast(null as double) else l_extendedprice * l_quantity end as value,
 case when l_discount = 0.0 then l_extendedprice end as censor_limit,
 case l_suppkey % 4 when 3 then 'ug/L' else 'mg/kg' end as unit,
 case l_linenumber when 1 then 'topsoil' when 2 then 'subsoil' else 'core' end as sample_type,
 case when o_custkey % 17 = 0 then cast(null as double) else cast(o_custkey * 7919 % 36000 as double) / cast(100 as double) - 180 end as lon,
 case when o_custkey % 17 = 0 then cast(null as double) else cast(o_custkey * 104729 % 18000 as double) / cast(100 as double) - 90 end as lat,
 case when l_orderkey % 29 = 0 then cast(null as string) else substr(cast(l_shipdate as string), 1, 10) end as sampled_at,
 cast(l_linenumber as double) / 2 as depth,
 concat('B', cast(cast(floor(l_orderkey / 4) as bigint) % 500 as string)) as batch_id,
 case l_suppkey % 5 when 0 then 'granite' when 1 then 'basalt' when 2 then cast(null as string) else 'shale' end as lithology,
 case when s_nationkey % 6 = 5 then cast(null as string) else concat('lic-', cast(s_nationkey % 2 as string)) end as license,
 concat('title-', cast(s_nationkey % 6 as string)) as title,
 case l_linestatus when 'F' then 'total' else 'partial' end as method_scope, concat('m', cast(s_nationkey % 4 as string)) as macroregion,
 case when s_nationkey % 8 = 7 then cast(null as string) else concat('c', cast(s_nationkey as string)) end as country,
 case when l_suppkey % 4 <> 3 then 'land' when l_suppkey % 3 = 0 then 'marine' else 'inland_water' end as domain,
 case s_nationkey % 3 when 0 then 'EPSG:4326' when 1 then 'WGS84' end as crs,
 case when l_suppkey % 4 = 3 then case when l_linenumber % 2 = 0 then 'dissolved' else 'total' end end as fraction,
 case s_nationkey % 4 when 0 then 'official' when 1 then 'journal' else 'supplement' end as tier,
 case when s_nationkey % 7 = 3 then 'ftp//no' when s_nationkey % 7 <> 5 then concat('https://data.example/', cast(s_nationkey as string)) end as url,
 case when s_nationkey % 5 <> 4 then concat('10.1/', cast(s_nationkey % 6 as string)) end as doi, concat('v', cast(s_nationkey % 2 as string)) as version,
 case when l_quantity > 35 then 'high' when l_quantity > 15 then 'medium' else 'low' end as band,
 l_orderkey * 8 + l_linenumber as source_row
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{supplier}} on l_suppkey = s_suppkey""",
    # Measurements as read: every column text.
    "raw": f"""
select {_ID} as record_id, cast(l_orderkey as string) as sample_id,
 case (l_partkey + l_linenumber) % 11 when 0 then concat('<', n) when 1 then 'ND' when 2 then '<LOD' when 3 then ' tr ' when 4 then concat(n, ',000') when 5 then 'not analyzed'
  when 6 then concat('>= ', n) when 7 then concat('-', n) when 8 then '  ' when 9 then 'bad value' else n end as value,
 case when l_orderkey % 13 = 0 then 'L' when l_orderkey % 17 = 0 then '≥' when l_orderkey % 31 = 0 then 'odd' end as value_qualifier,
 case when l_orderkey % 37 = 0 then '<LOQ' end as source_qualifier_raw,
 case l_suppkey % 5 when 0 then '0.5' when 1 then 'x' when 2 then '-1' end as detection_limit,
 case l_suppkey % 3 when 0 then '1.5' when 1 then '-2' end as quantitation_limit,
 case when l_orderkey % 19 = 0 then 'NR' when l_orderkey % 23 = 0 then 'lost' end as missing_reason,
 case l_partkey % 12 when 0 then 'mg/kg' when 1 then 'MG KG^-1' when 2 then 'µg/L' when 3 then 'ppb' when 4 then 'wt.%' when 5 then 'nmol/L' when 6 then 'nmol/kg'
  when 7 then 'micrograms per liter' when 8 then 'g/t' when 9 then 'ppm' when 10 then 'furlong' else ' mg/l' end as unit,
 case l_suppkey % 6 when 0 then 'Soils' when 1 then 'bedrock' when 2 then 'stream sediment' when 3 then 'Groundwater' when 4 then 'water' else 'moon' end as medium,
 case l_partkey % 9 when 0 then 'As' when 1 then 'LEAD' when 2 then 'zn' when 3 then 'SiO2' when 4 then 'Fe2O3' when 5 then 'FeO3T' when 6 then 'Copper' when 7 then 'XQ' else 'Ni' end as element_or_analyte,
 case when l_partkey % 14 = 0 then 'ZnO' when l_partkey % 15 = 0 then 'NiO' when l_partkey % 22 = 0 then 'As' end as species_or_oxide,
 case when o_custkey % 17 = 0 then cast(null as string) when o_custkey % 19 = 0 then 'n/a' when o_custkey % 23 = 0 then '0' else cast(o_custkey * 104729 % 181 - 90 as string) end as latitude,
 case when o_custkey % 13 = 0 then cast(null as string) when o_custkey % 23 = 0 then '0' else concat(cast(o_custkey * 7919 % 400 - 200 as string), '.25') end as longitude,
 case s_nationkey % 4 when 0 then 'EPSG:4326' when 1 then ' WGS84' when 2 then 'EPSG:3857' end as source_crs,
 case l_linenumber when 1 then '0' when 2 then 'deep' when 3 then '-1' when 4 then '4' end as sample_depth_min_m,
 case l_linenumber when 1 then '2' when 4 then '3' when 5 then '7' end as sample_depth_max_m,
 case l_returnflag when 'A' then 'ICP-MS after digestion' when 'N' then 'X-ray fluorescence' else 'Wet chemistry (b)' end as analytical_method,
 case when l_linestatus = 'F' and l_linenumber = 1 then 'Own Method!' end as method_family,
 case when l_linenumber = 7 then cast(null as string) else o_orderpriority end as measurement_basis,
 concat('src-', cast(s_nationkey % 6 as string)) as source_id,
 case s_nationkey % 6 when 0 then 'Government' when 1 then 'journal' when 2 then 'supplement' when 3 then 'blog' when 4 then 'official' end as source_tier,
 cast(l_orderkey * 8 + l_linenumber as string) as source_row,
 case s_nationkey % 6
  when 0 then substr(cast(l_shipdate as string), 1, 10)
  when 1 then concat(cast(day(l_shipdate) as string), '/', cast(month(l_shipdate) as string), '/', cast(year(l_shipdate) as string))
  when 2 then concat(cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string), '/', substr(cast(year(l_shipdate) as string), 3, 2))
  when 3 then case when l_linenumber = 1 then '1850' else cast(year(l_shipdate) as string) end
  when 4 then concat(cast(year(l_shipdate) as string), '/', cast(year(l_shipdate) + l_linenumber - 2 as string))
  else case when l_linenumber = 2 then substr(cast(l_shipdate as string), 1, 7) else cast(30000 + l_partkey % 9000 as string) end end as sampled_at
from (select *, cast(cast(floor(l_extendedprice) as bigint) as string) as n from {{lineitem}}) l join {{orders}} on l_orderkey = o_orderkey join {{supplier}} on l_suppkey = s_suppkey""",
    # Laboratory batches: 4 orders in a row make a reference material, a blank and a duplicate pair.
    "batch_qc": """
select concat('B', cast(cast(floor(o_orderkey / 4) as bigint) % 500 as string)) as batch_id,
 case o_orderkey % 4 when 0 then 'CRM' when 1 then 'BLANK' else 'DUPLICATE' end as qc_type, o_orderkey as qc_id,
 cast(case o_orderkey % 4 when 0 then 85 + o_custkey % 40 when 1 then o_custkey % 7 else 50 + o_custkey % 12 end as double) as value,
 case when o_orderkey % 4 = 0 then cast(100 as double) end as certified_value,
 case when o_orderkey % 4 >= 2 then cast(floor(o_orderkey / 4) as bigint) end as pair_id, case when o_orderkey % 41 = 0 then 'ppm' else 'mg/kg' end as unit from {orders}""",
    # Stations through time.
    "series": """
select user_id as station, event_type as element, ts, cast(year(ts) as double) + (cast(month(ts) as double) - 1) / 12 + cast(day(ts) as double) / 366 as t,
 value, case when event_id % 5 = 0 then 'ug/L' else 'mg/L' end as unit from {events}""",
    # Measurements with some contaminated places: a hundredth of the places, three of their measurements in four.
    "sites": """
select record_id, sample_id, source_id, lineage, element, medium, method_family, basis, qualifier, unit, sample_type, lon, lat, sampled_at, lithology, source_row, value * case
 when cast(round((lat + 90) * 100) as bigint) % 97 = 0 and source_row % 4 <> 0 then cast(10000 as double) else cast(1 as double) end as value from (OBS) o""",
    # Their outliers (on the Spark side by the operator itself).
    "flagged": """
select record_id, sample_id, source_id, element, medium, lon, lat, lithology, source_row, case when z > 0 then 'high' else 'low' end as direction
from (select w.*, 0.67448975 * (log10(value) - med) / mad as z
 from (select *, case when qualifier = 'lt' or value is null or value <= 0 then 1 else 0 end as why from (SITES) s0) w
 join (select element, medium, unit, count(*) as total, count(*) filter (where qualifier <> 'lt' and value > 0) as used, median(log10(value)) filter (where qualifier <> 'lt' and value > 0) as med from (SITES) s1 group by element, medium, unit) g using (element, medium, unit)
 join (select s2.element, s2.medium, s2.unit, median(abs(log10(value) - med2)) as mad from (SITES) s2 join (select element, medium, unit, median(log10(value)) filter (where qualifier <> 'lt' and value > 0) as med2 from (SITES) s3 group by element, medium, unit) g2
  on s2.element = g2.element and s2.medium = g2.medium and s2.unit = g2.unit where qualifier <> 'lt' and value > 0 group by s2.element, s2.medium, s2.unit) m using (element, medium, unit)
 where why = 0 and total >= 8 and used >= 8 and used / total >= 0.7 and mad > 0) a where abs(z) >= 3.5""",
    # Anomaly candidates as others claim them.
    "claimed": """
select record_id, sample_id, element, medium, lon, lat, lithology, case when source_row % 2 = 0 then 'high' else 'low' end as direction
from (OBS) o where source_row % 11 = 0""",
    # Record evidence with planted gaps, extra rows and changes.
    "evidence": """
select record_id, source_id, case when source_row % 97 = 0 then 'changed' else title end as title, license, concat('file-', source_id) as source_file,
 case when source_row % 211 = 0 then 'h-bad' else concat('h-', source_id) end as file_hash, element as analyte, lon, lat
from (OBS) o where source_row % 53 <> 0
union all select concat(record_id, 'x'), 'src-9', title, license, 'file-9', 'h-9', element, lon, lat from (OBS) o where source_row % 401 = 0""",
}
for _k in ("sites", "claimed", "evidence"):
    VIEWS[_k] = VIEWS[_k].replace("OBS", VIEWS["obs"])
VIEWS["flagged"] = VIEWS["flagged"].replace("SITES", VIEWS["sites"])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The driver tables and views of one folder as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        # The JVM doesn't compile methods over 8000 bytes: wide rule projections run faster in split methods.
        if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")

    @property
    def keyed(self) -> DataFrame:
        """The measurements with ``sample_key``, the key by which their tables are joined and that sample_id is made of: rows
        that are grouped by it lie together after that join and aren't shuffled again."""
        return self.sql(VIEWS["obs"].replace("select ", "select l_orderkey as sample_key, ", 1))

    @property
    def screened(self) -> DataFrame:
        """What screening and the readers of outliers need of the sites, written: its scans then shuffle no join."""
        return written(self.sites.select("record_id", "sample_id", "source_id", "element", "medium", "unit", "qualifier", "value", "lon", "lat", "lithology", "source_row"))

    @property
    def flagged(self) -> DataFrame:
        return self.outliers(self.screened)

    def outliers(self, screened: DataFrame) -> DataFrame:
        """The outliers, few next to the measurements: written, as their readers join them several times."""
        found = robust_anomalies(screened, ["element", "medium", "unit"], stored=True)
        return written(found.select("record_id", "sample_id", "source_id", "element", "medium", "lon", "lat", "lithology", "source_row", "direction"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            return self.sql(VIEWS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{t: getattr(self, t) for t in TABLES if f"{{{t}}}" in text})


def query(name: str, sql: str | None = None):
    """Register ``body(tables)`` under ``name``. In ``sql`` the views may be named; it may start with more CTEs (", x as")."""

    def add(body: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: body(Tables(spark, sf_dir))
        if sql:
            used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
            text = sql.strip()
            ctes = ",\n".join(f"{v} as ({VIEWS[v]})" for v in used)
            own = text[1:] if text.startswith(",") else text
            joiner = ",\n" if used and text.startswith(",") else "\n"
            full = (f"with {ctes}{joiner}{own}" if used else f"with {own}" if text.startswith(",") else own)
            ORACLE_SQL[name] = re.sub(r"\{(" + "|".join(TABLES) + r")\}", r"\1", full)
        return body

    return add
