"""Queries of the per-row functions (P1 to P28) and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardize as S
from ..functions import times
from ..functions import vocab as V
from ..operators import rows
from .base import query


def case(expr: str, values: dict, otherwise: str = "null") -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else f"cast({v!r} as double)"
    return f"case {expr} " + " ".join(f"when '{k}' then {lit(v)}" for k, v in values.items()) + f" else {otherwise} end"


NUM = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
PRE = r"^(<=|>=|<|>|≤|≥|~)?\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)$"
CENSORED = ", ".join(f"'{c}'" for c in V.CENSORED)


def num(c: str) -> str:
    plain = f"replace(nullif(trim({c}), ''), ',', '')"
    return f"case when regexp_matches({plain}, '{NUM}') then try_cast({plain} as double) end"


PARSED = rf"""
, p0 as (select *, replace(nullif(trim(value), ''), ',', '') as plain, nullif(trim(missing_reason), '') as given from raw),
p1 as (select *, {case("lower(plain)", V.MISSING_REASONS)} as reason_word, {case("lower(plain)", V.QUALIFIERS)} as word, {case("lower(given)", V.MISSING_REASONS)} as known,
  regexp_matches(plain, '{PRE}') as numeric, regexp_extract(plain, '{PRE}', 1) as sign, regexp_extract(plain, '{PRE}', 2) as digits from p0),
p2 as (select *, coalesce(nullif(trim(value_qualifier), ''), nullif(trim(source_qualifier_raw), ''), nullif(sign, ''), case when word is not null then trim(value) end) as said,
  reason_word is null and coalesce(numeric, false) as is_number from p1),
p3 as (select *, case when is_number then try_cast(digits as double) end as number,
  case when said is not null then coalesce({case("lower(said)", V.QUALIFIERS)}, 'unknown') when plain is null then 'unknown' when reason_word is not null then 'unknown'
    when is_number then coalesce({case("sign", V.QUALIFIERS)}, 'reported') else coalesce(word, 'unknown') end as qualifier,
  plain is not null and reason_word is null and not is_number and word is null as invalid,
  {num("detection_limit")} as dl0, {num("quantitation_limit")} as ql0 from p2),
p4 as (select *, case when given is not null then coalesce(known, 'unknown') when reason_word is not null then reason_word when invalid then 'invalid_value' when plain is null then 'not_reported' end as reason,
  case when dl0 >= 0 then dl0 end as dl, case when ql0 >= 0 then ql0 end as ql from p3),
parsed as (select *, case when qualifier in ('lt','le','gt','ge') and number is not null then number when qualifier = 'loq' then ql else dl end as censoring_limit,
  case when number is null then reason end as missing_reason_value from p4)
"""


@query(
    "p1_parse_measurement",
    PARSED
    + f"""select record_id, number, qualifier, censoring_limit, dl as detection_limit_value, ql as quantitation_limit_value, missing_reason_value,
 array_to_string(list_filter([case when given is not null and known is null then 'INVALID_MISSING_REASON' end, case when plain is null or reason_word is not null then 'MISSING_VALUE' end,
  case when invalid then 'INVALID_NUMERIC_VALUE' end, case when number is not null and reason is not null and not (given is not null and known is null) then 'INVALID_MISSING_REASON' end,
  case when nullif(trim(detection_limit), '') is not null and dl is null then 'INVALID_DETECTION_LIMIT' end, case when nullif(trim(quantitation_limit), '') is not null and ql is null then 'INVALID_QUANTITATION_LIMIT' end,
  case when qualifier in ({CENSORED}) then 'CENSORED_VALUE' end, case when qualifier = 'trace' then 'UNQUANTIFIED_TRACE' end,
  case when qualifier in ({CENSORED}) and qualifier <> 'trace' and censoring_limit is null then 'NONDETECT_WITHOUT_LIMIT' end, case when number < 0 then 'NEGATIVE_CONCENTRATION' end], lambda x: x is not null), ',') as value_flags
 from parsed""",
)
def p1(t):
    out = S.parse_measurement(t.raw)
    return out.select("record_id", "number", "qualifier", "censoring_limit", "detection_limit_value", "quantitation_limit_value", "missing_reason_value", F.concat_ws(",", "value_flags").alias("value_flags"))


@query(
    "p2_source_qualifier",
    rf"""select record_id, coalesce(nullif(trim(source_qualifier_raw), ''), nullif(trim(value_qualifier), ''), nullif(regexp_extract(replace(trim(value), ',', ''), '{PRE}', 1), ''),
 case when {case("lower(replace(nullif(trim(value), ''), ',', ''))", V.QUALIFIERS)} is not null then trim(value) end) as source_qualifier from raw""",
)
def p2(t):
    raw = t.raw
    return raw.select("record_id", S.source_qualifier({c: F.col(c) for c in raw.columns}).alias("source_qualifier"))


UNIT = {"mg/kg": "mg/kg", "MG KG^-1": "mg/kg", "µg/L": "ug/l", "ppb": "ppb", "wt.%": "wt%", "nmol/L": "nmol/l", "nmol/kg": "nmol/kg", "micrograms per liter": "ug/l", "g/t": "g/t", "ppm": "ppm", "furlong": "furlong", " mg/l": "mg/l"}


@query("p3_canonical_unit", f"select record_id, {case('unit', UNIT)} as canonical_unit from raw")
def p3(t):
    return t.raw.select("record_id", S.canonical_unit(F.col("unit")).alias("canonical_unit"))


def _analyte_sql() -> str:
    return f"""
, a0 as (select *, nullif(trim(element_or_analyte), '') as nm, nullif(trim(species_or_oxide), '') as sp, {case("medium", {"Soils": "soil", "bedrock": "rock", "stream sediment": "sediment", "Groundwater": "water", "water": "water"}, "'unknown'")} as med, {case("unit", UNIT)} as u from raw),
a1 as (select *, {case("upper(nm)", {k: v[1] for k, v in V.OXIDES.items()})} as nel, {case("upper(nm)", {k: v[0] for k, v in V.OXIDES.items()})} as nform, {case("upper(sp)", {k: v[1] for k, v in V.OXIDES.items()})} as sel, {case("upper(sp)", {k: v[0] for k, v in V.OXIDES.items()})} as sform,
  case lower(nm) when 'as' then 'As' when 'lead' then 'Pb' when 'zn' then 'Zn' when 'copper' then 'Cu' when 'ni' then 'Ni' else nm end as sym, lower(nm) in ('as','lead','zn','copper','ni') as known from a0),
a2 as (select *, case when sp is null and nel is not null then nel when not known and upper(nm) = upper(sp) and sel is not null then sel else sym end as analyte,
  case when sp is null and nel is not null then nform when sp is null and upper(nm) like '%O%' and regexp_matches(nm, '[0-9]') then nm else coalesce(sform, sp) end as species,
  known or (sp is null and nel is not null) or coalesce(upper(nm) = upper(sp) and sel is not null, false) as recognized from a1),
a3 as (select *, {case("upper(species)", {k: v[1] for k, v in V.OXIDES.items()})} as oel, {case("upper(species)", {k: S.V.oxide_fraction(k) for k in V.OXIDES})} as frac,
  case when med in ('soil','rock','sediment') then {case("u", V.SOLID_FACTORS)} end as solid,
  species is null or upper(species) = upper(analyte) and analyte in ('As','Pb','Zn','Cu','Ni','Si','Fe') as own from a2),
a4 as (select *, case when solid is not null then solid when med <> 'water' then null when u = 'nmol/kg' then 1.0 when u = 'nmol/l' then case when species is null or species = analyte then {case("analyte", V.MOLAR_MASSES)} / 1000 end else {case("u", V.WATER_FACTORS)} end as unit_factor,
  case when own then 1.0 when oel = analyte then frac end as species_factor from a3)
"""


@query(
    "p4_unit_conversion",
    _analyte_sql()
    + """select record_id, unit_factor, case when unit_factor is null then null when solid is not null then 'mg/kg' when u = 'nmol/kg' then 'nmol/kg' else 'ug/L' end as normalized_unit,
 case when unit_factor is not null then null when med = 'water' and u = 'nmol/l' then case when species is not null and species <> analyte then 'UNSUPPORTED_MOLAR_SPECIES' else 'UNSUPPORTED_MOLAR_MASS' end
  when med = 'water' and u in ('ppm','ppb','wt%','mg/kg') then 'AMBIGUOUS_AQUEOUS_RATIO_UNIT' else 'UNSUPPORTED_UNIT' end as unit_flag from a4""",
)
def p4(t):
    return S.standardize(t.raw).select("record_id", "unit_factor", "normalized_unit", "unit_flag")


@query("p5_resolve_analyte", _analyte_sql() + "select record_id, analyte, recognized as analyte_recognized, species from a4")
def p5(t):
    return S.resolve_analyte(t.raw).select("record_id", "analyte", "analyte_recognized", "species")


@query(
    "p6_species_factor",
    _analyte_sql() + "select record_id, round(species_factor, 9) as species_factor, case when own then null when frac is null then 'UNSUPPORTED_SPECIES_CONVERSION' when oel <> analyte then 'OXIDE_ELEMENT_MISMATCH' end as species_flag from a4",
)
def p6(t):
    return S.species_factor(S.resolve_analyte(t.raw)).select("record_id", F.round("species_factor", 9).alias("species_factor"), "species_flag")


@query(
    "p7_normalize_value",
    PARSED
    + _analyte_sql()
    + f"""select p.source_row, p.sample_id, p.number, round(case when p.qualifier not in ({CENSORED}) and p.number >= 0 then p.number * a.unit_factor * a.species_factor end, 6) as normalized_value,
 round(case when p.qualifier in ({CENSORED}) then p.censoring_limit * a.unit_factor * a.species_factor end, 6) as normalized_limit from
 (select *, row_number() over (partition by record_id order by value) as k from parsed) p join (select *, row_number() over (partition by record_id order by value) as k from a4) a on p.record_id = a.record_id and p.k = a.k""",
)
def p7(t):
    return S.standardize(t.raw).select("source_row", "sample_id", "number", F.round("normalized_value", 6).alias("normalized_value"), F.round("normalized_limit", 6).alias("normalized_limit"))


@query(
    "p8_normalize_vocab",
    f"select record_id, {case('lower(trim(medium))', V.MEDIA, chr(39) + 'unknown' + chr(39))} as medium, {case('lower(trim(source_tier))', V.TIERS, chr(39) + 'unknown' + chr(39))} as source_tier from raw",
)
def p8(t):
    return t.raw.select("record_id", S.normalize_vocab(F.col("medium"), V.MEDIA).alias("medium"), S.normalize_vocab(F.col("source_tier"), V.TIERS).alias("source_tier"))


@query(
    "p9_method_family",
    "select record_id, case when method_family is not null then 'own_method' when analytical_method like 'ICP%' then 'icp_ms' when analytical_method like 'X%' then 'xrf' else 'other_wet_chemistry_b' end as method_family from raw",
)
def p9(t):
    return t.raw.select("record_id", S.method_family(F.col("method_family"), F.col("analytical_method")).alias("method_family"))


COORD = f"""
, c0 as (select *, {num("latitude")} as la, {num("longitude")} as lo, nullif(trim(latitude), '') is not null as hla, nullif(trim(longitude), '') is not null as hlo from raw),
c1 as (select *, la is not null and lo is not null as whole, coalesce(la between -90 and 90 and lo between -180 and 180, false) as valid from c0)
"""


@query(
    "p10_normalize_coordinates",
    COORD
    + """select record_id, case when valid then la end as lat_value, case when valid then lo end as lon_value,
 array_to_string(list_filter([case when (hla or hlo) and not whole then 'INCOMPLETE_COORDINATE' end, case when (hla or hlo) and not whole or whole and not valid then 'INVALID_COORDINATE' end,
  case when whole and not valid and lo between -90 and 90 and la between -180 and 180 then 'POSSIBLE_COORDINATE_SWAP' end, case when valid and la = 0 and lo = 0 then 'ZERO_ISLAND_COORDINATE' end,
  case when valid and not ((lo >= 150 or lo <= 60) and la between -60 and 70) then 'OUTSIDE_REQUEST_REGION' end], lambda x: x is not null), ',') as coordinate_flags from c1""",
)
def p10(t):
    out = S.normalize_coordinates(t.raw, (150.0, -60.0, 60.0, 70.0))
    return out.select("record_id", "lat_value", "lon_value", F.concat_ws(",", "coordinate_flags").alias("coordinate_flags"))


@query(
    "p11_crs_gate",
    COORD
    + """select record_id, case when valid and lower(trim(source_crs)) in ('epsg:4326','wgs84') then la end as lat_value, case when valid and lower(trim(source_crs)) in ('epsg:4326','wgs84') then lo end as lon_value,
 case when valid and source_crs is null then 'MISSING_SOURCE_CRS' when valid and lower(trim(source_crs)) not in ('epsg:4326','wgs84') then 'UNSUPPORTED_SOURCE_CRS' end as crs_flag from c1""",
)
def p11(t):
    return S.crs_gate(S.normalize_coordinates(t.raw)).select("record_id", "lat_value", "lon_value", "crs_flag")


@query(
    "p12_coordinate_policy_join",
    "select record_id, coalesce(nullif(trim(source_crs), ''), case when source_id in ('src-1','src-3') then 'EPSG:4326' when source_id = 'src-5' and false then 'x' end) as source_crs, source_crs is null and source_id in ('src-1','src-3') as policy_applied from raw",
)
def p12(t):
    policies = t.spark.createDataFrame(
        [("src-1", "^10\\.1/", ["latitude", "longitude"], "EPSG:4326"), ("src-3", "^10\\.1/src", ["latitude", "longitude"], "EPSG:4326"), ("src-5", "^99", ["latitude", "longitude"], "EPSG:3857")],
        "source_id string, doi_pattern string, fields array<string>, crs string",
    )
    raw = t.raw.withColumns({"doi": F.concat(F.lit("10.1/"), "source_id"), "lat_field": F.lit("latitude"), "lon_field": F.lit("longitude")})
    return rows.coordinate_policy_join(raw, policies).select("record_id", "source_crs", "policy_applied")


@query(
    "p13_coordinate_resolution",
    COORD
    + """select record_id, round(greatest(case when la is not null then 111320.0 end, case when lo is not null then 0.01 * 111320.0 * abs(cos(radians(la))) * case when regexp_matches(longitude, '\\.') then 1 else 100 end end), 3) as metres
 from c1 where la is not null and lo is not null""",
)
def p13(t):
    raw = t.raw.filter(S.number(F.col("latitude")).isNotNull() & S.number(F.col("longitude")).isNotNull())
    return raw.select("record_id", F.round(S.coordinate_resolution(F.col("latitude"), F.col("longitude")), 3).alias("metres"))


@query("p14_accuracy_status", COORD + f"select record_id, case when not valid then 'not_applicable' when {num('detection_limit')} >= 0 then 'source_reported_uncertainty' else 'not_reported' end as status from c1")
def p14(t):
    out = S.normalize_coordinates(t.raw)
    return out.select("record_id", S.accuracy_status(F.col("lat_value"), F.col("detection_limit")).alias("status"))


@query(
    "p15_normalize_depth",
    f"""
, d as (select record_id, {num("sample_depth_min_m")} as a, {num("sample_depth_max_m")} as b, nullif(trim(sample_depth_min_m), '') is not null and {num("sample_depth_min_m")} is null as ua, nullif(trim(sample_depth_max_m), '') is not null and {num("sample_depth_max_m")} is null as ub from raw),
e as (select *, ua or ub or coalesce(a < 0, false) or coalesce(b < 0, false) as void from d)
select record_id, case when not void then a end as depth_min, case when not void then b end as depth_max, case when void or a > b then 'DEPTH_RANGE_INVALID' end as depth_flag from e""",
)
def p15(t):
    return S.normalize_depth(t.raw).select("record_id", "depth_min", "depth_max", "depth_flag")


FORMATS = {"src-0": "iso8601", "src-1": "dmy_slash", "src-2": "mdy_slash_2digit", "src-3": "year", "src-4": "year_range_slash", "src-5": "excel_serial_day"}
TIMES = r"""
, x as (select record_id, source_id, nullif(trim(sampled_at), '') as s from raw),
y as (select *, case source_id when 'src-0' then case when regexp_matches(s, '^\d{4}-\d{2}-\d{2}$') then s end
  when 'src-1' then strftime(try_strptime(s, '%d/%m/%Y'), '%Y-%m-%d') when 'src-2' then strftime(try_strptime(s, '%m/%d/%y'), '%Y-%m-%d')
  when 'src-3' then case when regexp_matches(s, '^\d{4}$') and cast(s as int) between 1900 and 2035 then s end
  when 'src-4' then case when cast(substr(s, 1, 4) as int) between 1900 and cast(substr(s, 6, 4) as int) and cast(substr(s, 6, 4) as int) <= 2035 then s end
  else case when regexp_matches(s, '^\d+$') then strftime(date '1899-12-30' + cast(s as int), '%Y-%m-%d') end end as z from x),
dated as (select *, case when z is null then null when source_id = 'src-3' then 'year' when source_id = 'src-4' then 'year_range' else 'day' end as prec,
  case when z is not null then 'reported' when s is null then 'not_reported' else 'unparseable' end as status from y)
"""


def _formats(t):
    return t.spark.createDataFrame(list(FORMATS.items()), "source_id string, raw_format string")


@query("p16_normalize_sampling_time", TIMES + "select record_id, z as sampling_time, prec as sampling_time_precision, status as sampling_time_status from dated")
def p16(t):
    return times.normalize_sampling_time(t.raw, _formats(t)).select("record_id", "sampling_time", "sampling_time_precision", "sampling_time_status")


@query(
    "p17_time_interval",
    TIMES
    + """
, q as (select record_id, prec, cast(substr(z, 1, 4) as int) as y, case prec when 'year_range' then cast(substr(z, 6, 4) as int) else cast(substr(z, 1, 4) as int) end as y2, case when prec = 'day' then cast(z as date) end as d from dated where z is not null)
select record_id, round(case prec when 'day' then y + (dayofyear(d) - 1) / (case when y % 4 = 0 and (y % 100 <> 0 or y % 400 = 0) then 366 else 365 end) else y end, 6) as t_start,
 round(case prec when 'day' then y + dayofyear(d) / (case when y % 4 = 0 and (y % 100 <> 0 or y % 400 = 0) then 366 else 365 end) else y2 + 1 end, 6) as t_end from q""",
)
def p17(t):
    out = times.normalize_sampling_time(t.raw, _formats(t)).filter("sampling_time is not null")
    i = times.time_interval(F.col("sampling_time"), F.col("sampling_time_precision"))
    return out.select("record_id", F.round(i["start"], 6).alias("t_start"), F.round(i["end"], 6).alias("t_end"))


@query(
    "p18_year_bounds_overlap",
    r"""select record_id from (select record_id, list_transform(regexp_extract_all(sampled_at, '(?:18|19|20)\d{2}'), lambda x: cast(x as int)) as y from raw) where list_max(y) >= 1994 and list_min(y) <= 1996""",
)
def p18(t):
    return t.raw.filter(times.year_bounds_overlap(F.col("sampled_at"), 1994, 1996)).select("record_id")


@query(
    "p19_qc_flags",
    f"""select case qualifier when 'lt' then 'CENSORED_VALUE' else '' end as flag_text, cast(count(*) as bigint) as n, cast(sum(case when value is null and qualifier <> 'lt' then 1 else 0 end) as bigint) as errors,
 cast(sum(case when lon is null then 1 else 0 end + case when license is null then 1 else 0 end) as bigint) as warnings, cast(sum(case when qualifier = 'lt' then 1 else 0 end) as bigint) as infos from obs group by 1""",
)
def p19(t):
    flag = S.flags(("MISSING_VALUE", F.col("value").isNull() & (F.col("qualifier") != "lt")), ("INCOMPLETE_COORDINATE", F.col("lon").isNull()), ("MISSING_LICENSE", F.col("license").isNull()), ("CENSORED_VALUE", F.col("qualifier") == "lt"))
    df = t.obs.withColumn("f", flag).withColumn("n", S.severity_counts(F.col("f")))
    text = F.when(F.array_contains("f", "CENSORED_VALUE"), "CENSORED_VALUE").otherwise("")
    sums = [F.sum(f"n.{c}").cast("bigint").alias(c) for c in ("errors", "warnings", "infos")]
    return df.groupBy(text.alias("flag_text")).agg(F.count("*").alias("n"), *sums)


def confidence_sql(table: str = "obs", errors: str = "0", warnings: str = "0") -> str:
    """CTE ``f`` with the components of ``table`` and v, the capped sum; further errors and warnings may be added."""
    return f"""
, x as (select *, case source_id when 'src-0' then 0.95 when 'src-1' then 0.9 else 0.3 end - case when license is null then 0.1 else 0 end as s, lon is not null as located,
  case when value is null and qualifier <> 'lt' then 1 else 0 end + {errors} as e, case when license is null then 1 else 0 end + {warnings} as w, case when qualifier = 'lt' then 1 else 0 end as i, case when basis is not null then 1 else 0 end as b from {table}),
y as (select *, (14 + b + case when license is not null then 1 else 0 end + case when located then 1 else 0 end) / 17.0::double as c, (3 + b) / 4.0::double as m, case when located then 0.95 else 0 end as sp,
  greatest(0, 1 - 0.35 * e - 0.08 * w - 0.02 * i)::double as q from x),
z as (select *, 0.3 * s + 0.2 * c + 0.2 * m + 0.15 * sp + 0.15 * q as o from y),
f as (select *, least(o, case when e > 0 then 0.59 else 9 end, case when not located then 0.59 else 9 end, case when m < 1 then 0.79 else 9 end, case when medium in ('rock','soil','sediment') and lithology is null then 0.79 else 9 end) as v from z)
"""


def scored(o):
    """Measurements with what the confidence score reads, and that score."""
    lit = {"analytical_method": "method_family", "digestion_or_extraction": "unit", "analyte": "element", "analyte_reported": "element", "source_locator": "source_id", "dataset_title": "title", "dataset_version": "title"}
    df = o.withColumns({k: F.col(v) for k, v in lit.items()}).withColumns(
        {
            "measurement_basis": F.col("basis"), "source_file": F.lit("f"), "file_sha256": F.lit("h"), "latitude": F.col("lat"), "longitude": F.col("lon"), "source_crs": F.lit("EPSG:4326"),
            "coordinate_uncertainty_m": F.lit(500.0), "sediment_environment": F.lit("river"), "geologic_unit": F.lit(None).cast("string"),
            "source_tier": F.when(F.col("source_id") == "src-0", "government").when(F.col("source_id") == "src-1", "peer_reviewed").otherwise("unknown"),
            "qc_flags": S.flags(("MISSING_VALUE", F.col("value").isNull() & (F.col("qualifier") != "lt")), ("MISSING_LICENSE", F.col("license").isNull()), ("CENSORED_VALUE", F.col("qualifier") == "lt")),
        }
    )
    return S.confidence_score(df)


@query(
    "p20_confidence_score",
    confidence_sql() + "select record_id, round(s, 5)::double as source, round(c, 5)::double as completeness, round(q, 5)::double as qc, round(v, 5)::double as overall, case when v >= 0.8 then 'high' when v >= 0.6 then 'medium' else 'low' end as band from f",
)
def p20(t):
    return scored(t.obs).select("record_id", *[F.round(F.col("confidence")[k], 5).alias(k) for k in ("source", "completeness", "qc", "overall")], F.col("confidence.band").alias("band"))


@query(
    "p21_stable_ids",
    """select record_id, concat('gen-', substr(sha256(concat_ws(chr(31), source_id, sample_id, element, cast(source_row as varchar))), 1, 16)) as stable_id,
 cast(row_number() over (partition by source_id, sample_id, element, source_row order by record_id) as int) as occurrence from obs""",
)
def p21(t):
    return rows.with_stable_ids(t.obs, ["source_id", "sample_id", "element", "source_row"], "record_id").select("record_id", "stable_id", "occurrence")


@query("p22_spatial_domain", "select record_id, case when medium in ('Groundwater','water','stream sediment') then 'inland_water' else 'land' end as domain from raw")
def p22(t):
    return t.raw.select("record_id", S.spatial_domain(F.col("medium")).alias("domain"))


_SOME = (("CENSORED_VALUE", "qualifier = 'lt'"), ("MISSING_VALUE", "value is null and qualifier <> 'lt'"), ("MISSING_SOURCE_CRS", "crs is null"))


@query(
    "p23_evidence_layer",
    """
, p as (select *, array_to_string(list_filter([case when version is null then 'version' end, case when license is null then 'license' end, case when doi is null then 'doi' end, case when not coalesce(regexp_matches(url, '^https?://[^/ ]+'), false) then 'url' end], lambda x: x is not null), ',') as missing_provenance,
 case when source_row % 9 = 0 then 'not_evaluated' when value is null and qualifier <> 'lt' then 'blocked' else 'clear' end as qc_status from obs),
g as (select *, array_to_string(list_filter([case when missing_provenance <> '' then 'strict_provenance' end, case when lon is null then 'coordinate' end, case when method_family is null and basis is null then 'method' end,
 case when lithology is null and domain <> 'marine' then 'geology' end, case when value is null then 'quantity' end], lambda x: x is not null), ',') as gaps from p)
select record_id, missing_provenance, gaps, qc_status, case when gaps = '' and qc_status = 'clear' then 'strict' when url is not null then 'traceable' else 'incomplete' end as layer from g""",
)
def p23(t):
    df = t.obs.withColumn("qc_flags", F.when(F.col("source_row") % 9 != 0, S.flags(*[(n, F.expr(c)) for n, c in _SOME])))
    e = rows.evidence_layer(df, V.ERROR_FLAGS)
    return e.select("record_id", *[F.concat_ws(",", c).alias(c) for c in ("missing_provenance", "gaps")], "qc_status", "layer")


@query(
    "p24_geologic_display",
    "select record_id, coalesce(case when medium in ('rock','soil') then lithology end, concat('background:', source_id)) as label, case when medium in ('rock','soil') and lithology is not null then 'formal_unit' else 'publisher_background' end as basis from obs",
)
def p24(t):
    df = t.obs.withColumns({"formal": F.when(F.col("medium").isin("rock", "soil"), F.col("lithology")), "background": F.concat(F.lit("background:"), "source_id")})
    shown = rows.geologic_display({"formal_unit": F.col("formal"), "publisher_background": F.col("background")})
    return df.select("record_id", shown["label"].alias("label"), shown["basis"].alias("basis"))


@query("p25_resolve_value", "select record_id, coalesce(value, censor_limit) as shown_value, qualifier = 'lt' as censored, unit from obs")
def p25(t):
    v = rows.resolve_value(F.col("value"), F.col("unit"), F.col("qualifier"), F.col("censor_limit"), F.lit(None).cast("double"), F.lit(None).cast("string"))
    return t.obs.select("record_id", F.coalesce(v["value"], v["limit"]).alias("shown_value"), v["censored"].alias("censored"), v["unit"].alias("unit"))


@query(
    "p26_semantic_enrichment",
    "select record_id, case when source_id = 'src-0' and sample_type = 'topsoil' then 'A horizon' when source_id = 'src-0' and sample_type = 'subsoil' then 'B horizon' when source_id = 'src-1' and sample_type = 'core' then 'drill core' end as controlled_type, not (source_id = 'src-0' and sample_type in ('topsoil','subsoil') or source_id = 'src-1' and sample_type = 'core') as unmapped from obs",
)
def p26(t):
    contracts = t.spark.createDataFrame([("src-0", "topsoil", "A horizon"), ("src-0", "subsoil", "B horizon"), ("src-1", "core", "drill core")], "source_id string, sample_type string, controlled_type string")
    return rows.semantic_enrichment(t.obs, contracts).select("record_id", "controlled_type", "unmapped")


@query("p27_latitude_band", "select record_id, case when abs(lat) >= 66.5 then 'polar' when abs(lat) >= 50 then 'subpolar' when abs(lat) >= 35 then 'temperate' when abs(lat) >= 23.5 then 'subtropical' when lat is not null then 'tropical' end as band from obs")
def p27(t):
    return t.obs.select("record_id", S.latitude_band(F.col("lat")).alias("band"))


#: The issues in SQL, from the same table of rules.
ISSUES = ", i as (select record_id, source_id, unnest(list_filter([" + ", ".join(f"case when {w} then '{c}|{o}|{s}|{st}' end" for c, o, s, st, w in rows.ISSUES) + "], lambda x: x is not null)) as s from obs), iss as (select split_part(s, '|', 1) as code, split_part(s, '|', 2) as owner, split_part(s, '|', 3) as severity, split_part(s, '|', 4) as status, record_id, source_id from i)"


@query("p28_row_issues", ISSUES + " select *, concat('issue-', substr(sha256(concat_ws(chr(31), code, record_id)), 1, 16)) as item_id from iss")
def p28(t):
    return rows.row_issues(t.obs)


@query("f9_profile_filter", "select record_id from obs where medium = 'soil' and sample_type = 'topsoil' and method_family = 'xrf'")
def f9(t):
    return rows.profile_filter(t.obs, {"medium": "soil", "sample_type": "topsoil", "method_family": "xrf"}).select("record_id")


@query(
    "f1_request_filter",
    """
, r as (select *, case when element not in ('As','Pb','Zn') then 'element' when medium not in ('soil','water') then 'medium' when source_id = 'src-5' then 'source' when basis is null or lower(basis) not like '%high%' and lower(basis) not like '%urgent%' then 'basis'
  when lon is null or not (lon between -100 and 150 and lat between -50 and 60) then 'region' when sampled_at is null or cast(substr(sampled_at, 1, 4) as int) not between 1993 and 1997 then 'time' end as reason from obs)
select coalesce(reason, 'kept') as outcome, cast(count(*) as bigint) as n from r group by 1""",
)
def f1(t):
    request = {"elements": ["As", "Pb", "Zn"], "media": ["soil", "water"], "without_sources": ["src-5"], "bases": ["high", "urgent"], "box": (-100.0, -50.0, 150.0, 60.0), "years": (1993, 1997)}
    _, counts = rows.request_filter(t.obs, request)
    return counts


@query("f2_basis_matches", "select record_id from obs where lower(basis) like '%high%' or regexp_replace(lower(basis), '[^a-z0-9]+', '_', 'g') = '5_low'")
def f2(t):
    return t.obs.filter(rows.basis_matches(F.col("basis"), ["high", "5-LOW"])).select("record_id")


@query("f3_geology_label_filter", "select record_id from obs where lithology in ('granite','shale') or concat('class-', cast(source_row % 4 as varchar)) = 'class-2'")
def f3(t):
    df = t.obs.withColumn("matched", F.concat(F.lit("class-"), (F.col("source_row") % 4).cast("string")))
    return rows.geology_label_filter(df, ["granite", "Shale", "class-2"], ["lithology", "matched"]).select("record_id")
