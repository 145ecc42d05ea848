"""Per-row standardization: every rule is a column expression; ``standardize`` strings them into one projection.

Names ending in ``_raw`` stay as read. A blank text is null throughout. Flags are collected as an ordered, distinct
array. A censored row has a limit instead of a value and never both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab as V
from .names import scratch

NUMBER = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"
PREFIXED = rf"^(<=|>=|<|>|≤|≥|~)?\s*({NUMBER})$"


def blank_to_null(c: Column) -> Column:
    # Not nullif, whose operand gets a projection of its own, under another name wherever the expression occurs.
    return F.when(F.trim(c) != "", F.trim(c))


def lookup(key: Column, values: Mapping[str, object]) -> Column:
    """The value of ``key`` in a small literal map, null if it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def number(c: Column) -> Column:
    """A plain decimal number, thousands commas allowed; null otherwise."""
    plain = F.replace(blank_to_null(c), F.lit(","), F.lit(""))
    return F.when(plain.rlike(f"^{NUMBER}$"), plain.try_cast("double"))


def flags(*rules: tuple[str, Column]) -> Column:
    """The names of the rules that hold, in order, each once. Unlike ``array_compact``, a function with a lambda, the
    difference of two arrays leaves the rules compiled."""
    return F.array_except(F.array(*[F.when(c, F.lit(name)) for name, c in rules]), F.array(F.lit(None).cast("string")))


def source_qualifier(row: Mapping[str, Column]) -> Column:
    """What the source says about a value: its qualifier columns, else the sign before the number, else the word."""
    plain = F.replace(blank_to_null(row["value"]), F.lit(","), F.lit(""))
    sign = F.nullif(F.regexp_extract(plain, PREFIXED, 1), F.lit(""))
    word = F.when(lookup(F.lower(plain), V.QUALIFIERS).isNotNull(), blank_to_null(row["value"]))
    return F.coalesce(blank_to_null(row["source_qualifier_raw"]), blank_to_null(row["value_qualifier"]), sign, word)


@scratch("_plain", "_said", "_given", "_dl", "_ql", "_sign", "_digits", "_reason_word", "_word", "_said_word", "_given_word", "_invalid", "_reason")
def parse_measurement(df: DataFrame) -> DataFrame:
    """Add number, qualifier, limits, missing_reason and value_flags, from the value text and its companions."""
    c = {n: F.col(n) for n in ("value", "value_qualifier", "source_qualifier_raw", "detection_limit", "quantitation_limit", "missing_reason")}
    # One step reads what the step before computed, so no text is matched or looked up twice.
    df = df.withColumns(
        {
            "_plain": F.replace(blank_to_null(c["value"]), F.lit(","), F.lit("")), "_said": F.coalesce(blank_to_null(c["value_qualifier"]), source_qualifier(c)),
            "_given": blank_to_null(c["missing_reason"]), "_dl": number(c["detection_limit"]), "_ql": number(c["quantitation_limit"]),
        }
    )
    plain, said, given = F.col("_plain"), F.col("_said"), F.col("_given")
    df = df.withColumns(
        {
            "_sign": F.regexp_extract(plain, PREFIXED, 1), "_digits": F.regexp_extract(plain, PREFIXED, 2), "_reason_word": lookup(F.lower(plain), V.MISSING_REASONS),
            "_word": lookup(F.lower(plain), V.QUALIFIERS), "_said_word": lookup(F.lower(said), V.QUALIFIERS), "_given_word": lookup(F.lower(given), V.MISSING_REASONS),
        }
    )
    reason_word, word = F.col("_reason_word"), F.col("_word")
    is_number = reason_word.isNull() & (F.col("_digits") != "")
    invalid = plain.isNotNull() & reason_word.isNull() & ~is_number & word.isNull()
    from_text = F.when(is_number, F.coalesce(lookup(F.col("_sign"), V.QUALIFIERS), F.lit("reported"))).when(reason_word.isNull(), word)
    known = F.when(given.isNotNull(), F.coalesce("_given_word", F.lit("unknown")))
    df = df.withColumns(
        {
            "number": F.when(is_number, F.col("_digits").try_cast("double")), "qualifier": F.coalesce(F.when(said.isNotNull(), F.coalesce("_said_word", F.lit("unknown"))), from_text, F.lit("unknown")),
            "_invalid": invalid, "_reason": F.coalesce(known, reason_word, F.when(invalid, "invalid_value"), F.when(plain.isNull(), "not_reported")),
        }
    )
    limit = {"detection_limit": F.col("_dl"), "quantitation_limit": F.col("_ql")}
    bad = {n: blank_to_null(c[n]).isNotNull() & (limit[n].isNull() | (limit[n] < 0)) for n in limit}
    good = {n: F.when(limit[n] >= 0, limit[n]) for n in limit}
    num, q = F.col("number"), F.col("qualifier")
    censor = F.when(q.isin("lt", "le", "gt", "ge") & num.isNotNull(), num).when(q == "loq", good["quantitation_limit"]).otherwise(good["detection_limit"])
    rules = (
        ("INVALID_MISSING_REASON", given.isNotNull() & F.col("_given_word").isNull()),
        ("MISSING_VALUE", plain.isNull() | reason_word.isNotNull()),
        ("INVALID_NUMERIC_VALUE", F.col("_invalid")),
        ("INVALID_MISSING_REASON", num.isNotNull() & F.col("_reason").isNotNull()),
        ("INVALID_DETECTION_LIMIT", bad["detection_limit"]),
        ("INVALID_QUANTITATION_LIMIT", bad["quantitation_limit"]),
        ("CENSORED_VALUE", q.isin(*V.CENSORED)),
        ("UNQUANTIFIED_TRACE", q == "trace"),
        ("NONDETECT_WITHOUT_LIMIT", q.isin(*V.CENSORED) & (q != "trace") & censor.isNull()),
        ("NEGATIVE_CONCENTRATION", num < 0),
    )
    out = df.withColumns(
        {
            "censoring_limit": censor, "detection_limit_value": good["detection_limit"], "quantitation_limit_value": good["quantitation_limit"],
            "missing_reason_value": F.when(num.isNull(), F.col("_reason")), "value_flags": flags(*rules),
        }
    )
    return out.drop("_plain", "_said", "_given", "_dl", "_ql", "_sign", "_digits", "_reason_word", "_word", "_said_word", "_given_word", "_invalid", "_reason")


def canonical_unit(c: Column) -> Column:
    """One spelling per unit: lower case, short words, a slash, no white space."""
    out = F.lower(blank_to_null(c))
    for old, new in V.UNIT_WORDS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.replace(F.regexp_replace(out, r"\s+", ""), F.lit("per"), F.lit("/"))
    for base in ("kg", "g", "l"):
        out = F.regexp_replace(out, rf"{base}\^?-?1$", f"/{base}")
    out = F.replace(out, F.lit("//"), F.lit("/"))
    return F.coalesce(lookup(out, V.UNIT_ALIASES), out)


@scratch("_unit")
def unit_conversion(df: DataFrame, medium: str = "medium", unit: str = "unit", analyte: str = "analyte", species: str = "species") -> DataFrame:
    """Add unit_factor, normalized_unit and unit_flags: solids go to mg/kg, water to ug/L; nmol/kg stays."""
    df = df.withColumn("_unit", canonical_unit(F.col(unit)))
    u, m, a, s = F.col("_unit"), F.col(medium), F.col(analyte), F.col(species)
    solid, water = m.isin(*V.SOLID_MEDIA) & lookup(u, V.SOLID_FACTORS).isNotNull(), m == "water"
    other_species = s.isNotNull() & (s != "") & ~s.eqNullSafe(a)
    molar = water & (u == "nmol/l")
    mass = lookup(a, V.MOLAR_MASSES)
    factor = (
        F.when(solid, lookup(u, V.SOLID_FACTORS)).when(water & (u == "nmol/kg"), 1.0).when(molar, F.when(~other_species, mass / 1000.0)).when(water, lookup(u, V.WATER_FACTORS))
    )
    target = F.when(factor.isNull(), F.lit(None)).when(solid, "mg/kg").when(u == "nmol/kg", "nmol/kg").otherwise("ug/L")
    none = F.coalesce(~solid, F.lit(True)) & factor.isNull()
    flag = (
        F.when(molar & other_species, "UNSUPPORTED_MOLAR_SPECIES").when(molar & mass.isNull(), "UNSUPPORTED_MOLAR_MASS")
        .when(none & water & u.isin(*V.AMBIGUOUS_IN_WATER), "AMBIGUOUS_AQUEOUS_RATIO_UNIT").when(none, "UNSUPPORTED_UNIT")
    )
    return df.withColumns({"unit_factor": factor, "normalized_unit": target, "unit_flag": flag}).drop("_unit")


def species_key(c: Column) -> Column:
    plain = F.translate(blank_to_null(c), "₀₁₂₃₄₅₆₇₈₉", "0123456789")
    return F.nullif(F.upper(F.regexp_replace(plain, "[^A-Za-z0-9]", "")), F.lit(""))


def analyte_symbol(c: Column) -> Column:
    """(symbol, recognized) of an element name or symbol; other texts stay as they are."""
    text = blank_to_null(c)
    by_name = lookup(F.lower(text), V.ELEMENT_NAMES)
    symbol = F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1000)))
    known = symbol.isin(*V.ELEMENTS)
    out = F.coalesce(by_name, F.when(known, symbol), text, F.lit("unknown"))
    return F.struct(out.alias("symbol"), F.coalesce(by_name.isNotNull() | known, F.lit(False)).alias("recognized"))


@scratch("_name", "_species", "_nk", "_sk", "_a")
def resolve_analyte(df: DataFrame) -> DataFrame:
    """Add analyte, analyte_recognized, species, analyte_flag: an oxide names its element; compounds stay species."""
    df = df.withColumns({"_name": blank_to_null(F.col("element_or_analyte")), "_species": blank_to_null(F.col("species_or_oxide"))})
    name, given = F.col("_name"), F.col("_species")
    df = df.withColumns({"_nk": species_key(name), "_sk": species_key(given), "_a": analyte_symbol(name)})
    nk, sk, a = F.col("_nk"), F.col("_sk"), F.col("_a")
    formula, element = {k: v[0] for k, v in V.OXIDES.items()}, {k: v[1] for k, v in V.OXIDES.items()}
    inferred = given.isNull() & lookup(nk, element).isNotNull()
    compound = given.isNull() & nk.contains("O") & nk.rlike("[0-9]")
    both = ~a["recognized"] & nk.eqNullSafe(sk) & lookup(sk, element).isNotNull()
    out = df.withColumns(
        {
            "analyte": F.when(inferred, lookup(nk, element)).when(both, lookup(sk, element)).otherwise(a["symbol"]),
            "analyte_recognized": F.coalesce(inferred | both, F.lit(False)) | a["recognized"],
            "species": F.when(inferred, lookup(nk, formula)).when(compound, name).otherwise(F.coalesce(lookup(sk, formula), given)),
            "analyte_flag": F.when(inferred | both, "INFERRED_ELEMENT_FROM_OXIDE"),
        }
    )
    return out.drop("_name", "_species", "_nk", "_sk", "_a")


@scratch("_key")
def species_factor(df: DataFrame, species: str = "species", analyte: str = "analyte") -> DataFrame:
    """Add species_factor and species_flag: the element's mass fraction in the species reported."""
    df = df.withColumn("_key", species_key(F.col(species)))
    key, a = F.col("_key"), F.col(analyte)
    own = key.isNull() | ((key == F.upper(a)) & a.isin(*V.ELEMENTS))
    fraction, element = lookup(key, {k: V.oxide_fraction(k) for k in V.OXIDES}), lookup(key, {k: v[1] for k, v in V.OXIDES.items()})
    flag = F.when(own, F.lit(None)).when(fraction.isNull(), "UNSUPPORTED_SPECIES_CONVERSION").when(element != a, "OXIDE_ELEMENT_MISMATCH")
    return df.withColumns({"species_factor": F.when(own, 1.0).when(element == a, fraction), "species_flag": flag}).drop("_key")


def normalize_value(df: DataFrame) -> DataFrame:
    """Add normalized_value (uncensored, 0 or more) and normalized_limit (censored), rounded to 12 places."""
    censored = F.col("qualifier").isin(*V.CENSORED)
    factor = F.col("unit_factor") * F.col("species_factor")
    return df.withColumns(
        {
            "normalized_value": F.when(~censored & (F.col("number") >= 0), F.round(F.col("number") * factor, 12)),
            "normalized_limit": F.when(censored, F.round(F.col("censoring_limit") * factor, 12)),
        }
    )


def normalize_vocab(c: Column, values: Mapping[str, str], unknown: str = "unknown") -> Column:
    return F.coalesce(lookup(F.lower(blank_to_null(c)), values), F.lit(unknown))


def _slug(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))


def method_family(family: Column, method: Column) -> Column:
    """An explicit family as a slug, else the first pattern the method contains, else other_<slug>."""
    return _family(blank_to_null(family), F.lower(blank_to_null(method)))


def _family(given: Column, text: Column) -> Column:
    found: Column = F.concat(F.lit("other_"), _slug(text))
    for name, patterns in reversed(V.METHOD_PATTERNS):
        hit = text.contains(patterns[0])
        for p in patterns[1:]:
            hit = hit | text.contains(p)
        found = F.when(hit, name).otherwise(found)
    return F.when(given.isNotNull(), _slug(given)).when(text.isNotNull(), found)


@scratch("_given", "_text")
def with_method_family(df: DataFrame, family: str = "method_family", method: str = "analytical_method") -> DataFrame:
    """Replace ``family`` by the method family; the texts that all patterns read are made once a row."""
    df = df.withColumns({"_given": blank_to_null(F.col(family)), "_text": F.lower(blank_to_null(F.col(method)))})
    return df.withColumn(family, _family(F.col("_given"), F.col("_text"))).drop("_given", "_text")


def inside_box(lon: Column, lat: Column, box: Sequence[float]) -> Column:
    """Within west, south, east, north; a box with west > east crosses the antimeridian."""
    west, south, east, north = box
    across = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
    return across & lat.between(south, north)


@scratch("_la", "_lo")
def normalize_coordinates(df: DataFrame, box: Sequence[float] | None = None, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Replace text coordinates by lat_value, lon_value (both or none, in range) and coordinate_flags."""
    df = df.withColumns({"_la": number(F.col(lat)), "_lo": number(F.col(lon))})
    la, lo = F.col("_la"), F.col("_lo")
    has_la, has_lo = blank_to_null(F.col(lat)).isNotNull(), blank_to_null(F.col(lon)).isNotNull()
    whole = la.isNotNull() & lo.isNotNull()
    valid = F.coalesce(la.between(-90, 90) & lo.between(-180, 180), F.lit(False))
    broken = (has_la | has_lo) & ~whole
    outside = F.lit(False) if box is None else valid & ~inside_box(lo, la, box)
    return df.withColumns(
        {
            "lat_value": F.when(valid, la), "lon_value": F.when(valid, lo),
            "coordinate_flags": flags(
                ("INCOMPLETE_COORDINATE", broken), ("INVALID_COORDINATE", broken | (whole & ~valid)),
                ("POSSIBLE_COORDINATE_SWAP", whole & ~valid & lo.between(-90, 90) & la.between(-180, 180)),
                ("ZERO_ISLAND_COORDINATE", valid & (la == 0) & (lo == 0)), ("OUTSIDE_REQUEST_REGION", outside),
            ),
        }
    ).drop("_la", "_lo")


def crs_gate(df: DataFrame, crs: str = "source_crs") -> DataFrame:
    """Null canonical coordinates without a declared WGS84 system; add crs_flag."""
    c = F.lower(blank_to_null(F.col(crs)))
    located = F.col("lat_value").isNotNull() & F.col("lon_value").isNotNull()
    ok = c.isin(*V.WGS84)
    flag = F.when(located & c.isNull(), "MISSING_SOURCE_CRS").when(located & ~ok, "UNSUPPORTED_SOURCE_CRS")
    return df.withColumns({"crs_flag": flag, "lat_value": F.when(ok, F.col("lat_value")), "lon_value": F.when(ok, F.col("lon_value"))})


def coordinate_resolution(lat_text: Column, lon_text: Column) -> Column:
    """Metres that the decimal places of two coordinates imply: the larger of the two steps."""

    def step(text: Column) -> Column:
        digits = F.regexp_extract(blank_to_null(text), r"^[+-]?\d+(?:\.(\d*))?$", 1)
        return F.when(number(text).isNotNull(), F.pow(F.lit(10.0), -F.length(digits)))

    metre = F.lit(111320.0)
    return F.greatest(step(lat_text) * metre, step(lon_text) * metre * F.abs(F.cos(F.radians(number(lat_text)))))


def accuracy_status(lat: Column, uncertainty: Column) -> Column:
    return F.when(lat.isNull(), "not_applicable").when(number(uncertainty) >= 0, "source_reported_uncertainty").otherwise("not_reported")


@scratch("_low", "_high")
def normalize_depth(df: DataFrame, low: str = "sample_depth_min_m", high: str = "sample_depth_max_m") -> DataFrame:
    """Add depth_min, depth_max and depth_flag: an unreadable or negative depth voids both, an inverted range is flagged."""
    df = df.withColumns({"_low": number(F.col(low)), "_high": number(F.col(high))})
    a, b = F.col("_low"), F.col("_high")
    unread = (blank_to_null(F.col(low)).isNotNull() & a.isNull()) | (blank_to_null(F.col(high)).isNotNull() & b.isNull())
    void = unread | F.coalesce(a < 0, F.lit(False)) | F.coalesce(b < 0, F.lit(False))
    return df.withColumns({"depth_min": F.when(~void, a), "depth_max": F.when(~void, b), "depth_flag": F.when(void | (a > b), "DEPTH_RANGE_INVALID")}).drop("_low", "_high")


def severity_counts(flag_array: Column) -> Column:
    """struct<errors, warnings, infos> of an array of flags."""
    errors = F.size(F.filter(flag_array, lambda f: f.isin(*V.ERROR_FLAGS)))
    infos = F.size(F.filter(flag_array, lambda f: f.isin(*V.INFO_FLAGS)))
    return F.struct(errors.alias("errors"), (F.size(flag_array) - errors - infos).alias("warnings"), infos.alias("infos"))


def stable_id(prefix: str, *parts: Column) -> Column:
    """A SHA-256 id over parts in a fixed order; nulls and blanks differ from each other by their separators."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws(chr(31), *[F.coalesce(p.cast("string"), F.lit(chr(30))) for p in parts]), 256), 1, 16))


def spatial_domain(medium_text: Column) -> Column:
    """marine, inland_water or land, from the medium's text alone."""
    t = F.lower(F.coalesce(medium_text, F.lit("")))
    return F.when(t.rlike("marine|seawater|ocean|sea floor|seafloor"), "marine").when(t.rlike("water|river|lake|stream"), "inland_water").otherwise("land")


def latitude_band(lat: Column) -> Column:
    a = F.abs(lat)
    return F.when(a >= 66.5, "polar").when(a >= 50, "subpolar").when(a >= 35, "temperate").when(a >= 23.5, "subtropical").when(a.isNotNull(), "tropical")


def confidence_band(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.6, "medium").when(score.isNotNull(), "low")


@scratch("_n", "_c", "_overall", "_analytical")
def confidence_score(df: DataFrame) -> DataFrame:
    """Add the struct ``confidence``: five components, their weighted sum under its caps, band and gates."""
    has = lambda n: F.col(n).isNotNull() & (F.col(n).cast("string") != "")
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    method_fields = ("measurement_basis", "analytical_method", "method_family", "digestion_or_extraction")
    complete_fields = ("sample_id", "analyte", "analyte_reported", "medium", "measurement_basis", "unit", "source_id", "source_locator", "dataset_title", "dataset_version", "source_file", "source_row", "analytical_method", "method_family", "digestion_or_extraction", "license")
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    flag = F.col("qc_flags")
    bad_hash = F.col("source_file").isNotNull() & (F.col("file_sha256").isNull() | F.array_contains(flag, "INVALID_FILE_SHA256"))
    source = lookup(F.col("source_tier"), V.TIER_SCORES) - 0.15 * one(F.col("source_id").isNull()) - 0.25 * one(F.col("source_locator").isNull()) - 0.1 * one(F.col("license").isNull()) - 0.05 * one(bad_hash)
    present = one(located)
    for n in complete_fields:
        present = present + one(has(n) & (F.col(n).cast("string") != "unknown"))
    method = one(has(method_fields[0]))
    for n in method_fields[1:]:
        method = method + one(has(n))
    uncertainty = F.col("coordinate_uncertainty_m")
    near = F.when(uncertainty <= 100, 0.2).when(uncertainty <= 1000, 0.15).when(uncertainty <= 10000, 0.1).when(uncertainty.isNotNull(), 0.05).otherwise(0.0)
    spatial = 0.6 + 0.2 * one(F.col("source_crs").isNotNull()) + near
    spatial = F.when(~located, 0.0).otherwise(F.least(F.lit(1.0), F.when(F.array_contains(flag, "ZERO_ISLAND_COORDINATE"), F.least(F.lit(0.3), spatial)).otherwise(spatial)))
    df = df.withColumn("_n", severity_counts(flag))
    n = F.col("_n")
    qc = F.greatest(F.lit(0.0), 1.0 - 0.35 * n["errors"] - 0.08 * n["warnings"] - 0.02 * n["infos"])
    df = df.withColumn("_c", F.struct(F.greatest(F.lit(0.0), F.least(F.lit(1.0), source)).alias("source"), (present / 17.0).alias("completeness"), (method / 4.0).alias("method"), spatial.alias("spatial"), qc.alias("qc")))
    c = F.col("_c")
    overall = 0.3 * c["source"] + 0.2 * c["completeness"] + 0.2 * c["method"] + 0.15 * c["spatial"] + 0.15 * c["qc"]
    needs_geology = F.col("medium").isin("rock", "soil") | ((F.col("medium") == "sediment") & ~F.col("sediment_environment").eqNullSafe(F.lit("marine")))
    gates = (
        ("error_qc_low_cap", n["errors"] > 0, 0.59),
        ("incomplete_method_context_medium_cap", c["method"] < 1, 0.79),
        ("missing_canonical_coordinate_low_cap", ~located, 0.59),
        ("missing_coordinate_uncertainty_medium_cap", located & uncertainty.isNull(), 0.79),
        ("missing_geologic_context_medium_cap", F.coalesce(needs_geology, F.lit(False)) & ~has("geologic_unit") & ~has("lithology"), 0.79),
        ("synthetic_fixture_low_cap", F.coalesce(F.lower("source_id").startswith("synthetic"), F.lit(False)), 0.59),
    )
    # The least of the score and the caps that apply; nested, each cap would double the expression.
    overall = F.least(overall, *[F.when(hit, F.lit(cap)) for _, hit, cap in gates])
    analytical = F.least(0.55 * c["method"] + 0.45 * c["qc"], F.when(n["errors"] > 0, F.lit(0.59)), F.when(c["method"] < 1, F.lit(0.79)))
    out = df.withColumns({"_overall": overall, "_analytical": analytical})
    r = lambda x: F.round(x, 6)
    return out.withColumn(
        "confidence",
        F.struct(
            *[r(c[k]).alias(k) for k in ("source", "completeness", "method", "spatial", "qc")], r(F.col("_overall")).alias("overall"), confidence_band(F.col("_overall")).alias("band"),
            flags(*[(k, hit) for k, hit, _ in gates]).alias("gates"), r(F.col("_analytical")).alias("analytical_readiness"), confidence_band(F.col("_analytical")).alias("analytical_band"),
        ),
    ).drop("_n", "_c", "_overall", "_analytical")


def standardize(raw: DataFrame, box: Sequence[float] | None = None) -> DataFrame:
    """The whole per-row chain over a raw table, one projection deep in the plan; ``qc_flags`` joins all its flags."""
    df = normalize_value(species_factor(unit_conversion(resolve_analyte(parse_measurement(raw.withColumn("medium", normalize_vocab(F.col("medium"), V.MEDIA)))))))
    df = normalize_depth(crs_gate(normalize_coordinates(df, box)))
    one = lambda n: F.when(F.col(n).isNotNull(), F.array(n)).otherwise(F.array().cast("array<string>"))
    more = flags(("UNRECOGNIZED_ANALYTE", ~F.col("analyte_recognized")), ("UNRECOGNIZED_MEDIUM", F.col("medium") == "unknown"))
    every = F.concat("value_flags", one("analyte_flag"), more, one("unit_flag"), one("species_flag"), "coordinate_flags", one("crs_flag"), one("depth_flag"))
    return df.withColumn("qc_flags", F.array_distinct(every))
