"""Evidence checks, time series and the provenance of outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.names import fresh
from .ranking import join_on, quantiles, values_at
from .space import neighbor_count


def evidence_reconcile(obs: DataFrame, evidence: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(record_id, problem): missing on a side, repeated, or a field that differs (null equals null)."""
    a = obs.groupBy("record_id").agg(F.count("*").alias("_na"), *[F.min(f).alias(f"a_{f}") for f in fields])
    b = evidence.groupBy("record_id").agg(F.count("*").alias("_nb"), *[F.min(f).alias(f"b_{f}") for f in fields])
    both = a.join(b, "record_id", "full")
    here = F.col("_na").isNotNull() & F.col("_nb").isNotNull()
    checks = [F.when(F.col("_nb").isNull(), "missing_evidence"), F.when(F.col("_na").isNull(), "missing_record"), F.when(F.col("_nb") > 1, "repeated_evidence")]
    checks += [F.when(here & ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), f"conflict_{f}") for f in fields]
    return both.select("record_id", F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def evidence_orphans(obs: DataFrame, evidence: DataFrame, sources: DataFrame) -> DataFrame:
    """(record_id, problem): records without evidence, and evidence of unknown sources."""
    none = obs.join(evidence.select("record_id"), "record_id", "left_anti").select("record_id", F.lit("no_evidence").alias("problem"))
    unknown = evidence.join(sources.select("source_id"), "source_id", "left_anti").select("record_id", F.lit("unknown_source"))
    return none.union(unknown)


def hash_consistency(evidence: DataFrame, manifest: DataFrame) -> DataFrame:
    """(source_id, source_file, problem): several hashes for one file, and hashes that the manifest lacks."""
    several = evidence.groupBy("source_id", "source_file").agg(F.count_distinct("file_hash").alias("n")).filter("n > 1").select("source_id", "source_file", F.lit("several_hashes").alias("problem"))
    absent = evidence.select("source_id", "source_file", "file_hash").distinct().join(manifest.select("file_hash"), "file_hash", "left_anti").select("source_id", "source_file", F.lit("hash_not_in_manifest")).distinct()
    return several.union(absent)


def artifact_coordinate_check(obs: DataFrame, features: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(record_id, problem): two copies of a coordinate that differ, or are swapped."""
    both = obs.select("record_id", "lon", "lat").join(features.select("record_id", F.col("lon").alias("x"), F.col("lat").alias("y")), "record_id")
    apart = lambda a, b: F.abs(F.col(a) - F.col(b)) > tolerance
    swapped = ~apart("lon", "y") & ~apart("lat", "x")
    differs = apart("lon", "x") | apart("lat", "y") | (F.col("lon").isNull() != F.col("x").isNull())
    return both.filter(differs).select("record_id", F.when(swapped, "swapped").otherwise("differs").alias("problem")).distinct()


def source_binding_check(obs: DataFrame, manifest: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(source_id, field, mismatches): rows whose value is not among their source's declared ones (array columns)."""
    joined = obs.join(manifest.select("source_id", *[F.col(f).alias(f"_{f}") for f in fields]), "source_id", "left")
    wrong = [F.struct(F.lit(f).alias("field"), (F.col(f).isNotNull() & ~F.coalesce(F.array_contains(f"_{f}", F.col(f)), F.lit(False))).cast("int").alias("w")) for f in fields]
    return joined.select("source_id", F.inline(F.array(*wrong))).groupBy("source_id", "field").agg(F.sum("w").alias("mismatches")).filter("mismatches > 0")


def expected_count_reconcile(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """(source_id, observed, expected, status): match, drift, or baseline where nothing is registered."""
    n = observed.groupBy("source_id").agg(F.count("*").alias("observed"))
    both = n.join(expected, "source_id", "left")
    status = F.when(F.col("expected").isNull(), "baseline").when(F.col("observed") == F.col("expected"), "match").otherwise("drift")
    return both.select("source_id", "observed", "expected", status.alias("status"))


def compact_evidence(evidence: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """Fields constant within (source, file, hash) stay on the group's first row only and are null on the others."""
    first, *marks = fresh(evidence, "first", *[f"{f} is constant" for f in fields])
    const = evidence.groupBy(*keys).agg(*[(F.count_distinct(f) + F.max(F.col(f).isNull().cast("int")) <= 1).alias(m) for f, m in zip(fields, marks)], F.min(order).alias(first))
    joined = evidence.join(const, list(keys))
    anchor = F.col(order) == F.col(first)
    return joined.withColumns({**{f: F.when(~F.col(m) | anchor, F.col(f)) for f, m in zip(fields, marks)}, "anchor": anchor}).drop(first, *marks)


def source_manifest(obs: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per source: sorted distinct titles, licences, DOIs, versions, tiers, addresses, (file, hash, address) triples and
    citations, and located / licensed / verified records (verified: the record's title is the evidence's)."""
    own = obs.select("record_id", "source_id", "lon", F.col("license").alias("own_license"), F.col("title").alias("own_title"), "doi", "version", "tier", "url")
    both = own.join(evidence.select("record_id", "title", "license", "source_file", "file_hash"), "record_id")
    triple = F.concat_ws("#", "source_file", "file_hash", F.coalesce("url", F.lit("")))
    cited = F.concat_ws(", ", F.col("title"), F.col("version"), F.col("doi"))
    sets = {"titles": "title", "licenses": "license", "dois": "doi", "versions": "version", "tiers": "tier", "urls": "url", "files": triple, "citations": cited}
    return both.groupBy("source_id").agg(
        *[F.concat_ws(";", F.array_sort(F.collect_set(c))).alias(n) for n, c in sets.items()], F.count_if(F.col("lon").isNotNull()).alias("located"),
        F.count_if(F.col("own_license").isNotNull()).alias("licensed"), F.count_if(F.col("own_title") == F.col("title")).alias("verified"), F.count("*").alias("records"),
    )


def station_key(rows: DataFrame, prefixed: Mapping[str, str] | None = None, digits: int = 2) -> Column:
    """The station of a row: what comes before a separator in the sample id where ``prefixed`` names one for the source,
    else the source and its coordinates rounded to ``digits``; null without coordinates."""
    lon, lat = F.round("lon", digits), F.round("lat", digits)
    cell = F.when(lon.isNotNull() & lat.isNotNull(), F.concat_ws("|", F.lit("cell"), F.coalesce("source_id", F.lit("")), lat.cast("string"), lon.cast("string")))
    for source, mark in (prefixed or {}).items():
        named = (F.col("source_id") == source) & F.contains(F.col("sample_id"), F.lit(mark))
        cell = F.when(named, F.concat_ws("|", F.lit("station"), F.lit(source), F.substring_index("sample_id", mark, 1))).otherwise(cell)
    return cell


def station_series(rows: DataFrame, least: int = 3) -> DataFrame:
    """station, element, unit, points, dropped, first, last: the majority unit of each series (the smaller name of equally
    frequent ones) with ``least`` times or more. ``station_points`` has the points themselves."""
    by = rows.groupBy("station", "element", "unit").agg(F.count("*").alias("n"), F.count_distinct("t").alias("points"), F.min("t").alias("first"), F.max("t").alias("last"))
    w = Window.partitionBy("station", "element")
    vote = by.withColumn("k", F.row_number().over(w.orderBy(F.desc("n"), "unit"))).withColumn("dropped", F.sum("n").over(w) - F.col("n")).filter("k = 1")
    return vote.filter(F.col("points") >= least).select("station", "element", "unit", "points", "dropped", "first", "last")


def station_points(rows: DataFrame, least: int = 3, size: int = 1000) -> DataFrame:
    """station, element, unit, chunk, points: the series of ``station_series`` in order of time, then value, ``size`` points
    (t, value) a row, chunks numbered from 0.

    The points of a series are sorted by Spark, which spills, and numbered as they pass; no row holds more than ``size``.
    """
    series = station_series(rows, least).select("station", "element", "unit")
    kept = join_on(rows.select("station", "element", "unit", "t", "value"), series, ["station", "element", "unit"])
    at = F.row_number().over(Window.partitionBy("station", "element").orderBy("t", "value"))
    chunk = kept.withColumn("at", at).withColumn("chunk", F.floor((F.col("at") - 1) / size).cast("int"))
    held = chunk.groupBy("station", "element", "unit", "chunk").agg(F.sort_array(F.collect_list(F.struct("at", "t", "value"))).alias("points"))
    return held.withColumn("points", F.transform("points", lambda p: F.struct(p["t"].alias("t"), p["value"].alias("value"))))


def linear_trend(points: DataFrame, t: str, v: str, keys: Sequence[str], share: float = 0.15) -> DataFrame:
    """Per key: slope, intercept, span, and rising / falling / stable as the fitted change against a share of the median."""
    g = points.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope(v, t).alias("slope"), F.regr_intercept(v, t).alias("intercept"), (F.max(t) - F.min(t)).alias("span"))
    g = join_on(g, quantiles(points, keys, v, {"median": 0.5}), keys, "left")
    change, edge = F.col("slope") * F.col("span"), share * F.abs("median")
    return g.withColumn("trend", F.when(change > edge, "rising").when(change < -edge, "falling").when(change.isNotNull(), "stable").otherwise("undetermined"))


def source_time_summary(dated: DataFrame, formats: DataFrame) -> DataFrame:
    """Per source: records, dated, undated, unparseable, the declared format (basis), and why rows are undated."""
    s = F.col("sampling_time_status")
    by = dated.groupBy("source_id").agg(F.count("*").alias("records"), F.count_if(s == "reported").alias("dated"), F.count_if(s == "not_reported").alias("undated"), F.count_if(s == "unparseable").alias("unparseable"))
    out = by.join(formats.select("source_id", F.col("raw_format").alias("basis")), "source_id", "left")
    reason = F.when(F.col("basis").isNull(), "no_declared_format").when(F.col("dated") == F.col("records"), "all_dated").when(F.col("unparseable") > F.col("undated"), "does_not_fit_the_format").otherwise("not_reported")
    return out.withColumn("reason", reason)


def dated_summary(dated: DataFrame, formats: DataFrame) -> DataFrame:
    """(status, precision, n, unmapped): rows, and those whose source declares no format."""
    known = dated.join(formats.select("source_id", F.lit(1).alias("mapped")), "source_id", "left")
    return known.groupBy(F.col("sampling_time_status").alias("status"), F.col("sampling_time_precision").alias("precision")).agg(F.count("*").alias("n"), F.count_if(F.col("mapped").isNull()).alias("unmapped"))


def co_anomaly_elements(obs: DataFrame, flagged: DataFrame) -> DataFrame:
    """(sample_id, measured, flagged_high): sorted element sets of the samples with a high candidate."""
    high = flagged.filter("direction = 'high'").groupBy("sample_id").agg(F.array_sort(F.collect_set("element")).alias("flagged_high"))
    measured = obs.join(high.select("sample_id"), "sample_id", "left_semi").groupBy("sample_id").agg(F.array_sort(F.collect_set("element")).alias("measured"))
    return measured.join(high, "sample_id")


GEOGENIC, HUMAN, NEUTRAL, MISSING = "supports_geogenic", "supports_anthropogenic", "available_but_neutral", "unavailable"
LINES = ("lithology_line", "spatial_line", "association_line", "temporal_line")


def lithology_line(text: Column, element: Column) -> Column:
    """Geogenic if the rock is one that naturally holds much of the element."""
    said = F.upper(F.trim(text))
    known = F.lit(False)
    for words, elements in V.HIGH_BACKGROUND:
        known = known | (element.isin(*elements) & reduce(lambda a, b: a | b, [F.contains(said, F.lit(w)) for w in words]))
    return F.when(F.coalesce(said, F.lit("")) == "", MISSING).when(F.coalesce(known, F.lit(False)), GEOGENIC).otherwise(NEUTRAL)


def association_line(element: Column, measured: Column, flagged_high: Column) -> Column:
    """What else is high in the sample: a second chalcophile element speaks for people, a mafic one for the rock."""
    others = lambda xs: F.array_remove(F.coalesce(xs, F.array().cast("array<string>")), element)
    of = lambda suite: F.array_intersect(others(flagged_high), F.array(*[F.lit(e) for e in suite]))
    polluted = element.isin(*V.CHALCOPHILE) & (F.size(of(V.CHALCOPHILE)) > 0)
    mafic = element.isin(*V.MAFIC, "Cu") & (F.size(of(V.MAFIC)) > 0)
    return F.when(F.size(others(measured)) == 0, MISSING).when(polluted, HUMAN).when(mafic, GEOGENIC).otherwise(NEUTRAL)


def spatial_line(neighbours: Column, peers: Column) -> Column:
    """Two neighbours or more are a pattern of the ground; none, among three candidates or more, is a point source."""
    return F.when(neighbours.isNull(), MISSING).when(neighbours >= 2, GEOGENIC).when((neighbours == 0) & (peers >= 3), HUMAN).otherwise(NEUTRAL)


def temporal_lines(obs: DataFrame, wanted: DataFrame, share: float = 0.3, least: int = 3) -> DataFrame:
    """station, element, temporal_line for series in ``wanted`` (station, element) with ``least`` dated values of ``obs``
    (station, element, t, value): rising by over ``share`` of the upper median speaks for people, falling is
    neutral, stable geogenic. Series of one time, or whose median isn't positive, have no row."""
    keys = ["station", "element"]
    dated = obs.select(*keys, "t", "value").filter("station is not null and element is not null and t is not null and value is not null")
    dated = dated.join(wanted.select(*keys).distinct(), keys, "left_semi")
    fits = dated.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope("value", "t").alias("slope"), (F.max("t") - F.min("t")).alias("span")).filter((F.col("n") >= least) & (F.col("span") > 0))
    upper = values_at(dated, keys, F.col("value"), lambda b: b.withColumn("want", F.array(F.floor(F.col("n") / 2)))).select(*keys, F.col("v").alias("median"))
    change = F.col("slope") * F.col("span") / F.col("median")
    line = F.when(change > share, HUMAN).when(change < -share, NEUTRAL).otherwise(GEOGENIC)
    return fits.join(upper, keys).filter("median > 0").select(*keys, line.alias("temporal_line"))


def anomaly_provenance(obs: DataFrame, flagged: DataFrame, degrees: float = 1.0, share: float = 0.3, least: int = 3, prefixed: Mapping[str, str] | None = None) -> DataFrame:
    """record_id, four lines of evidence and ``class``, one row for each candidate; only enrichment is attributed.

    ``flagged`` has record_id, sample_id, source_id, element, medium, direction, lon, lat and lithology, and may have
    geologic_unit; ``obs`` has sample_id, source_id, element, lon, lat, value and the sampling year ``t``, null where no
    time was reported. Lines that agree, two or more, decide; lines on both sides are mixed; else the evidence is
    insufficient. ``prefixed`` is that of ``station_key``.
    """
    rock = F.concat_ws(" ", *[c for c in ("lithology", "lithology_raw", "geologic_unit") if c in flagged.columns])
    named = lambda df: df.filter("trim(sample_id) <> '' and trim(element) <> ''")
    co = co_anomaly_elements(named(obs), named(flagged)).select("sample_id", "measured", "flagged_high")
    rows = neighbor_count(flagged, degrees).withColumn("station", station_key(flagged, prefixed))
    dated = obs.withColumn("station", station_key(obs, prefixed))
    rows = join_on(rows, co, ["sample_id"], "left")
    rows = join_on(rows, temporal_lines(dated, rows.filter("direction = 'high'"), share, least), ["station", "element"], "left")
    lines = (
        lithology_line(rock, F.col("element")), spatial_line(F.col("neighbours"), F.col("peers")),
        association_line(F.col("element"), F.col("measured"), F.col("flagged_high")), F.coalesce("temporal_line", F.lit(MISSING)),
    )
    high = F.coalesce(F.col("direction") == "high", F.lit(False))
    out = rows.select("record_id", high.alias("high"), *[F.when(high, line).alias(n) for n, line in zip(LINES, lines)])
    count = lambda what: reduce(lambda a, b: a + b, [F.coalesce((F.col(n) == what).cast("int"), F.lit(0)) for n in LINES])
    ground, people = count(GEOGENIC), count(HUMAN)
    kind = (
        F.when(~F.col("high"), "not_applicable_depletion").when((ground >= 1) & (people >= 1), "mixed_or_undistinguished")
        .when(ground >= 2, "geogenic_background").when(people >= 2, "suspected_anthropogenic_input").otherwise("insufficient_evidence")
    )
    return out.select("record_id", *LINES, kind.alias("class"))


def usable_cohorts(cohorts: DataFrame, least: int) -> DataFrame:
    return cohorts.filter(F.col("tier").isin(*V.USABLE_TIERS) & (F.col("quantified_samples") >= least))


def cohort_pair_candidates(cohorts: DataFrame, layers: Mapping[str, tuple[Sequence[str], Sequence[str]]] = V.LAYERS, least: int = 50) -> DataFrame:
    """One row for each element and medium with a surface and a deep cohort of the same method whose boxes overlap: the pair
    with the most quantified samples in sum, and that sum. Only usable tiers with ``least`` quantified samples count."""
    usable = usable_cohorts(cohorts, least)
    of = lambda i: reduce(lambda a, b: a | b, [(F.col("medium") == m) & F.col("sample_type").isin(*pair[i]) for m, pair in layers.items()], F.lit(False))
    keys = ["element", "medium", "method_family"]
    told = [c for c in ("sample_type", "basis", "fraction", "method_scope", "unit") if c in cohorts.columns]
    side = lambda i, p: usable.filter(of(i)).select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in (*told, "quantified_samples", "west", "east", "south", "north")])
    met = side(0, "s").join(side(1, "d"), keys).filter("s_west <= d_east and d_west <= s_east and s_south <= d_north and d_south <= s_north")
    score = F.col("s_quantified_samples") + F.col("d_quantified_samples")
    ties = [f"{p}_{c}" for c in told for p in "sd"]
    w = Window.partitionBy("element", "medium").orderBy(F.desc("score"), "method_family", *ties)
    best = met.withColumn("score", score).withColumn("place", F.row_number().over(w)).filter("place = 1")
    return best.select(*keys, *ties, "score")


def fraction_pair_candidates(cohorts: DataFrame, suffixes: Mapping[str, str]) -> DataFrame:
    """(element, medium, stem, bulk, partial): sample types that differ by a bulk or partial suffix, boxes overlapping."""
    kind, stem = F.lit(None).cast("string"), F.col("sample_type")
    for suffix, name in suffixes.items():
        kind = F.when(F.col("sample_type").endswith(suffix), name).otherwise(kind)
        stem = F.when(F.col("sample_type").endswith(suffix), F.expr(f"substr(sample_type, 1, length(sample_type) - {len(suffix)})")).otherwise(stem)
    rows = cohorts.withColumns({"kind": kind, "stem": stem}).filter("kind is not null")
    of = lambda c, k: F.when(F.col("kind") == k, F.col(c))
    aggs = [F.sum(of("samples", k)).alias(k) for k in ("bulk", "partial")]
    for k in ("bulk", "partial"):
        aggs += [F.min(of("west", k)).alias(f"w_{k}"), F.max(of("east", k)).alias(f"e_{k}"), F.min(of("south", k)).alias(f"s_{k}"), F.max(of("north", k)).alias(f"n_{k}")]
    g = rows.groupBy("element", "medium", "stem").agg(*aggs).filter("bulk > 0 and partial > 0")
    return g.filter("w_bulk <= e_partial and w_partial <= e_bulk and s_bulk <= n_partial and s_partial <= n_bulk").select("element", "medium", "stem", "bulk", "partial")
