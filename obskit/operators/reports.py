"""Coverage, completeness, balance and readiness reports: grouped aggregates, one pass each.

Sets in the results are sorted arrays of short labels (sources, elements, media); their size follows the vocabulary.
Samples are counted, never collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.standardize import inside_box
from ..sources.storage import written
from .distinct import distinct_by_keys, rolled_up, together
from .provenance import usable_cohorts
from .ranking import join_on, numbered, quantiles
from .screening import cell_index

QUANTIFIED = "value is not null"


def _set(c: str) -> Column:
    return F.array_sort(F.collect_set(c))


def tall(df: DataFrame, columns: Sequence[str], key: str, value: str) -> DataFrame:
    """One row of numbers turned into (key, value) rows."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias(key), F.col(c).cast("double").alias(value)) for c in columns])))


def qc_report(obs: DataFrame, errors: Sequence[str], infos: Sequence[str]) -> DataFrame:
    """(section, key, n, rate): counts over all rows, rows by flag, flags by severity, rows by missing reason.

    Reads qc_flags, value, censor_limit, qualifier, missing_reason, lon, lat. ``rate`` is of all rows, for counts.
    """
    severity = lambda f: F.when(f.isin(*errors), "error").when(f.isin(*infos), "info").otherwise("warning")
    counts = {
        "records": F.lit(True), "standardized": F.col("value").isNotNull() | F.col("censor_limit").isNotNull(), "censored": F.col("qualifier") != "reported", "flagged": F.size("qc_flags") > 0,
        "error_flagged": F.exists("qc_flags", lambda f: f.isin(*errors)), "valid_coordinate": F.col("lon").isNotNull() & F.col("lat").isNotNull(),
    }
    one = obs.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    rows = one.select(F.inline(F.array(*[F.struct(F.lit("count").alias("section"), F.lit(n).alias("key"), F.col(n).alias("n"), F.round(F.try_divide(F.col(n), F.col("records")), 6).alias("rate")) for n in counts])))
    none = F.lit(None).cast("double")
    by_flag = obs.select(F.explode("qc_flags").alias("key")).groupBy("key").agg(F.count("*").alias("n")).select(F.lit("flag"), "key", "n", none)
    by_severity = obs.select(F.explode("qc_flags").alias("f")).groupBy(severity(F.col("f")).alias("key")).agg(F.count("*").alias("n")).select(F.lit("severity"), "key", "n", none)
    reasons = obs.filter("missing_reason is not null").groupBy(F.col("missing_reason").alias("key")).agg(F.count("*").alias("n")).select(F.lit("missing_reason"), "key", "n", none)
    return rows.union(by_flag).union(by_severity).union(reasons)


def confidence_report(scored: DataFrame, components: Sequence[str], dimensions: Sequence[str], score: str = "confidence") -> DataFrame:
    """(section, key, band, n, mean): component means, overall bands, gates applied, and bands and means of dimensions.

    ``score`` is a struct of the components, ``overall``, ``gates`` (array of names) and the dimensions.
    """
    band = F.when(F.col("x") >= 0.8, "high").when(F.col("x") >= 0.6, "medium").otherwise("low")
    part = lambda section, names: F.array(*[F.struct(F.lit(section).alias("section"), F.lit(n).alias("key"), F.col(f"{score}.{n}").cast("double").alias("x")) for n in names])
    rows = scored.select(F.inline(F.concat(part("component", [*components, "overall"]), part("dimension", dimensions))))
    means = rows.groupBy("section", "key").agg(F.count("*").alias("n"), F.avg("x").alias("mean")).select("section", "key", F.lit(None).cast("string").alias("band"), "n", "mean")
    banded = rows.filter((F.col("section") == "dimension") | (F.col("key") == "overall")).groupBy("key", band.alias("band")).agg(F.count("*").alias("n"))
    banded = banded.select(F.lit("band"), "key", "band", "n", F.lit(None).cast("double"))
    gates = scored.select(F.explode(f"{score}.gates").alias("key")).groupBy("key").agg(F.count("*").alias("n")).select(F.lit("gate"), "key", F.lit(None).cast("string"), "n", F.lit(None).cast("double"))
    return means.union(banded).union(gates)


COHORT = ("element", "medium", "sample_type", "fraction", "basis", "method_family", "method_scope", "unit")


def analysis_cohorts(obs: DataFrame, keys: Sequence[str] = COHORT, tiers: Mapping[str, float] | None = None) -> DataFrame:
    """Per cohort: quantified, censored, not normalized, quantified samples, sources, the dominant one's share, box, time
    range, rows by confidence band, and a tier by samples, quantified fraction and share (``tiers`` changes thresholds)."""
    t = {"samples": 20, "fraction": 0.7, "share": 0.9, "exploratory": 8} | dict(tiers or {})
    quantified = F.expr(QUANTIFIED)
    keys, sums = list(keys), ("n", "quantified", "censored", "not_normalized", "high_band", "medium_band", "low_band")
    ends = {"west": (F.min, "lon"), "east": (F.max, "lon"), "south": (F.min, "lat"), "north": (F.max, "lat"), "first": (F.min, "sampled_at"), "last": (F.max, "sampled_at")}
    # One pass over the rows; samples and sources are then counted from its groups, so nothing is expanded for distinct counts.
    # The groups are written: each count reads other columns of them, and Spark would make them anew for it.
    once = obs.groupBy(*keys, "sample_id", "source_id").agg(
        F.count("*").alias("n"), F.count_if(quantified).alias("quantified"), F.count_if(F.col("qualifier") != "reported").alias("censored"), F.count_if(F.expr("value is null and qualifier = 'reported'")).alias("not_normalized"),
        *[F.count_if(F.col("band") == b).alias(f"{b}_band") for b in ("high", "medium", "low")], *[f(c).alias(n) for n, (f, c) in ends.items()],
    )
    once = written(once)
    add = [F.sum(c).alias(c) for c in sums] + [f(n).alias(n) for n, (f, _) in ends.items()]
    named = F.col("sample_id").isNotNull()
    rest = once.groupBy(*keys, "sample_id").agg(*add).groupBy(*keys).agg(*add, F.count_if(named).alias("samples"), F.count_if(named & (F.col("quantified") > 0)).alias("quantified_samples"))
    by = once.groupBy(*keys, "source_id").agg(F.sum("n").alias("n"), F.sum("quantified").alias("q"))
    top = by.groupBy(*keys).agg(F.max_by("source_id", F.struct("n", "source_id")).alias("top_source"), (F.max("n") / F.sum("n")).alias("top_share"), F.count("*").alias("sources"), F.max("q").alias("top_quantified"), F.count_if(F.col("q") > 0).alias("quantified_sources"))
    order = ("quantified", "censored", "not_normalized", "samples", "quantified_samples", "west", "east", "south", "north", "first", "last", "high_band", "medium_band", "low_band")
    out = join_on(rest.select(*keys, *order), top, keys)
    enough = (F.col("quantified_samples") >= t["samples"]) & (F.col("quantified") >= t["fraction"] * (F.col("quantified") + F.col("censored") + F.col("not_normalized")))
    several = (F.col("quantified_sources") >= 2) & (F.col("top_quantified") <= t["share"] * F.col("quantified"))
    tier = F.when(enough & several, "analysis_ready").when(enough, "single_lineage_ready").when(F.col("quantified_samples") >= t["exploratory"], "exploratory_only").otherwise("insufficient_background")
    return out.withColumn("tier", tier).drop("top_quantified", "quantified_sources")


def sample_context(obs: DataFrame, order: str = "source_row") -> DataFrame:
    """One row per sample: the first non-null attributes in row order, depth and time ranges, element and source sets."""
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(order, "record_id"))).alias(c) for c in ("lithology", "basis", "license", "lon", "lat")]
    return obs.groupBy("sample_id").agg(*firsts, F.min("depth").alias("depth_min"), F.max("depth").alias("depth_max"), F.min("sampled_at").alias("first"), F.max("sampled_at").alias("last"), _set("element").alias("elements"), _set("source_id").alias("sources"))


def exclusion_counts(obs: DataFrame) -> DataFrame:
    """(reason, element, medium, n) of the rows that analyses leave out."""
    reason = F.when(F.col("qualifier") != "reported", "censored").when(F.col("value").isNull(), "not_standardized").when(F.col("lon").isNull(), "no_coordinate").when(F.col("basis").isNull(), "no_basis")
    return obs.withColumn("reason", reason).filter("reason is not null").groupBy("reason", "element", "medium").agg(F.count("*").alias("n"))


def database_coverage(obs: DataFrame, degrees: float = 10.0) -> DataFrame:
    """(view, key, records, samples, traceable, strict, ready) for the total and each dimension.

    Rows are first added up by all dimensions and the sample. A window over each sample's rows then tells which of them has
    a view's key as the first one, so samples are sums like the rest, and rows that are multiplied for views are added up
    by view and key at once, map-side: no task holds more than a few counts of them.
    """
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    traced, strict = F.col("license").isNotNull(), F.col("license").isNotNull() & F.col("url").startswith("https://") & F.col("doi").isNotNull()
    ready = strict & F.col("lon").isNotNull() & F.col("value").isNotNull()
    dims = ("element", "medium", "domain", "source_id", "lineage", "macroregion", "country")
    cell = F.when(F.col("lon").isNotNull(), F.concat_ws(":", y, x)).alias("cell")
    base = obs.groupBy(*dims, cell, "sample_id").agg(F.count("*").alias("records"), F.count_if(traced).alias("traceable"), F.count_if(strict).alias("strict"), F.count_if(ready).alias("ready"))
    named = {"total": F.lit("all"), "pair": F.concat_ws("|", "element", "medium"), "source": F.col("source_id"), "cell": F.col("cell")} | {d: F.col(d) for d in dims if d != "source_id"}
    counts = ("records", "traceable", "strict", "ready")
    # Rows without a sample open none; they are spread by what they hold.
    spread = F.when(F.col("sample_id").isNull(), F.xxhash64(*dims, "cell"))
    ahead = Window.partitionBy("sample_id", "spread").orderBy("records").rowsBetween(Window.unboundedPreceding, -1)
    opens = {n: F.col("sample_id").isNotNull() & ~F.array_contains(F.collect_set(k).over(ahead), k) for n, k in named.items()}
    marked = base.withColumn("spread", spread).select(*dims, "cell", *counts, *[o.alias(f"opens {n}") for n, o in opens.items()])
    view = lambda name, key: F.when(key.isNotNull(), F.struct(F.lit(name).alias("view"), key.alias("key"), F.col(f"opens {name}").alias("opens")))
    each = marked.select(*counts, F.inline(F.array(*[view(n, k) for n, k in named.items()]))).filter("view is not null")
    return each.groupBy("view", "key").agg(F.count_if("opens").alias("samples"), *[F.sum(c).alias(c) for c in counts])


def spatial_samples(obs: DataFrame) -> DataFrame:
    """One row per sample: its first point in row order, elements, media and domains."""
    at = F.when(F.col("lon").isNotNull(), F.struct("source_row", "record_id"))
    return obs.groupBy("sample_id").agg(F.min_by("lon", at).alias("lon"), F.min_by("lat", at).alias("lat"), _set("element").alias("elements"), _set("medium").alias("media"), _set("domain").alias("domains"))


def sample_views() -> Column:
    """The views a sample belongs to: overall, its elements, its media, and their pairs."""
    view = lambda name, key: F.struct(F.lit(name).alias("view"), key.alias("key"))
    pairs = F.flatten(F.transform("elements", lambda e: F.transform("media", lambda m: view("pair", F.concat_ws("|", e, m)))))
    return F.concat(F.array(view("overall", F.lit("all"))), F.transform("elements", lambda e: view("element", e)), F.transform("media", lambda m: view("medium", m)), pairs)


def occupied_cells(samples: DataFrame, degrees: float = 10.0) -> DataFrame:
    """(view, key, cell, samples) of the located samples."""
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    rows = samples.filter("lon is not null").select(F.concat_ws(":", y, x).alias("cell"), F.inline(sample_views()))
    return rows.groupBy("view", "key", "cell").agg(F.count("*").alias("samples"))


def grid_occupancy(occupied: DataFrame, target_grid: DataFrame) -> DataFrame:
    """(view, key, samples, cells, countries, zones, bands): per view, located samples, occupied cells, and what of the
    target grid (cell, country, zone, band) these cells cover."""
    placed = occupied.join(target_grid.select("cell", "country", "zone", "band"), "cell", "left")
    return placed.groupBy("view", "key").agg(F.sum("samples").alias("samples"), F.count("*").alias("cells"), *[F.count_distinct(c).alias(n) for c, n in (("country", "countries"), ("zone", "zones"), ("band", "bands"))])


def sufficiency_audit(occupied: DataFrame, target_grid: DataFrame, views: DataFrame, least_samples: int, least_cells: int, display: tuple[int, int] = (1, 1)) -> DataFrame:
    """Each asked view: counts, zones and bands of the target grid without a cell, status pass / gap / unassessable, the
    reasons of a gap, and whether it is at least fit for display (``display``: samples and cells)."""
    every = target_grid.agg(F.array_sort(F.collect_set("zone")).alias("all_zones"), F.array_sort(F.collect_set(F.col("band").cast("string"))).alias("all_bands"))
    placed = occupied.join(target_grid.select("cell", "zone", "band"), "cell", "left").groupBy("view", "key").agg(
        F.sum("samples").alias("samples"), F.count("*").alias("cells"), F.collect_set("zone").alias("zones"), F.collect_set(F.col("band").cast("string")).alias("bands")
    )
    out = views.join(placed, ["view", "key"], "left").crossJoin(every)
    lacks = lambda all_, have: F.array_except(all_, F.coalesce(have, F.array().cast("array<string>")))
    out = out.withColumns({"samples": F.coalesce("samples", F.lit(0)), "cells": F.coalesce("cells", F.lit(0)), "missing_zones": lacks("all_zones", F.col("zones")), "missing_bands": lacks("all_bands", F.col("bands"))})
    checks = (("too_few_samples", F.col("samples") < least_samples), ("too_few_cells", F.col("cells") < least_cells), ("missing_zones", F.size("missing_zones") > 0), ("missing_bands", F.size("missing_bands") > 0))
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks]))
    status = F.when(F.col("samples") == 0, "unassessable").when(F.size("reasons") == 0, "pass").otherwise("gap")
    shown = (F.col("samples") >= display[0]) & (F.col("cells") >= display[1])
    return out.withColumn("reasons", reasons).withColumns({"status": status, "display_pass": shown}).drop("zones", "bands", "all_zones", "all_bands")


def rank_country_targets(occupied: DataFrame, target_grid: DataFrame) -> DataFrame:
    """Countries with unfilled cells: missing zones first, then missing bands, then the most unfilled."""
    left = target_grid.join(occupied.select("cell").distinct().withColumn("_o", F.lit(1)), "cell", "left")
    size = lambda c, has: F.count_distinct(F.when(has, F.col(c)))
    filled = F.col("_o").isNotNull()
    g = left.groupBy("country").agg(F.count("*").alias("cells"), F.count_if(~filled).alias("unfilled"), (F.count_distinct("zone") - size("zone", filled)).alias("missing_zones"), (F.count_distinct("band") - size("band", filled)).alias("missing_bands"))
    w = Window.orderBy(F.desc("missing_zones"), F.desc("missing_bands"), F.desc("unfilled"), "country")
    return g.filter("unfilled > 0").withColumn("rank", F.row_number().over(w))


def country_coverage(occupied: DataFrame, target_grid: DataFrame, least_cells: int = 3, k: int = 10) -> DataFrame:
    """The ``k`` countries with the most target cells: occupied cells, share, and whether they reach the least."""
    g = target_grid.join(occupied.select("cell").distinct().withColumn("_o", F.lit(1)), "cell", "left").groupBy("country").agg(F.count("*").alias("cells"), F.count("_o").alias("occupied"))
    ranked = g.withColumn("rank", F.rank().over(Window.orderBy(F.desc("cells"), "country")))
    return ranked.filter(F.col("rank") <= k).withColumns({"share": F.col("occupied") / F.col("cells"), "enough": F.col("occupied") >= least_cells})


def dimension_gaps(occupied: DataFrame, target_grid: DataFrame, views: DataFrame) -> DataFrame:
    """(view, key, zone, west, south, east, north): each zone of the target grid in which a view has no cell."""
    zones = target_grid.groupBy("zone").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))
    have = occupied.join(target_grid.select("cell", "zone"), "cell").groupBy("view", "key").agg(F.collect_set("zone").alias("have"))
    every = zones.agg(F.collect_set("zone").alias("every"))
    asked = views.join(have, ["view", "key"], "left").join(F.broadcast(every))
    gaps = asked.select("view", "key", F.explode(F.array_except("every", F.coalesce("have", F.array().cast("array<string>")))).alias("zone"))
    return gaps.join(zones, "zone").select("view", "key", "zone", "west", "south", "east", "north")


def field_completeness(obs: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """(field, filled, missing, rate); a composite field is filled if all its columns are."""

    def filled(columns: Sequence[str]) -> Column:
        out = F.lit(True)
        for c in columns:
            out = out & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
        return F.coalesce(out, F.lit(False))

    one = obs.agg(F.count("*").alias("_n"), *[F.count_if(filled(c)).alias(n) for n, c in fields.items()])
    rows = one.select("_n", F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("filled")) for n in fields])))
    return rows.select("field", "filled", (F.col("_n") - F.col("filled")).alias("missing"), (F.col("filled") / F.col("_n")).alias("rate"))


CUBE = ("source_id", "medium", "element", "sample_type", "method_scope", "region", "basis")


def coverage_cube(obs: DataFrame, keys: Sequence[str] = CUBE, totals: bool = False, degrees: float = 1.0) -> DataFrame:
    """Per key combination (with totals: the roll-up of the keys as well): observations, samples, located samples,
    comparable rows, lineages, cells.

    Rows are added up once by keys, sample, lineage and cell, and written, as each count reads other columns of them; distinct samples, lineages and cells of every level are then
    sums (``distinct``), rolled up from the few rows by all keys.
    """
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    cell = F.when(F.col("lon").isNotNull(), y * 10000 + x)
    inner = [f"key {i}" for i in range(len(keys))]
    base = obs.select(*[F.col(f"`{k}`").alias(i) for k, i in zip(keys, inner)], "sample_id", "lineage", cell.alias("cell"), F.expr(QUANTIFIED).alias("quantified"))
    base = written(base.groupBy(*inner, "sample_id", "lineage", "cell").agg(F.count("*").alias("observations"), F.count_if(F.col("quantified")).alias("comparable")))
    levels = list(range(len(keys) + 1)) if totals else [len(keys)]
    counted = [
        base.groupBy(*inner).agg(F.sum("observations").alias("observations"), F.sum("comparable").alias("comparable")),
        distinct_by_keys(base, inner, "sample_id", "samples", levels, {"located_samples": F.col("cell").isNotNull()}),
        distinct_by_keys(base, inner, "lineage", "lineages", levels), distinct_by_keys(base, inner, "cell", "cells", levels),
    ]
    out = rolled_up(together(counted, inner), inner, ["observations", "comparable"], ["samples", "located_samples", "lineages", "cells"], levels)
    return out.select(*[F.col(i).alias(k) for i, k in zip(inner, keys)], "observations", "samples", "located_samples", "comparable", "lineages", "cells")


def source_profile(obs: DataFrame) -> DataFrame:
    """Per source: rows, samples, box, and rows by region, reference system, fraction, method, type and medium as text."""
    base = obs.groupBy("source_id").agg(F.count("*").alias("records"), F.count_distinct("sample_id").alias("samples"), F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"), F.count_if(F.col("lon").isNull()).alias("unlocated"))
    names = {"regions": "macroregion", "systems": "crs", "fractions": "fraction", "methods": "method_family", "types": "sample_type", "media": "medium"}
    tally = obs.select("source_id", F.inline(F.array(*[F.struct(F.lit(n).alias("what"), F.coalesce(F.col(c), F.lit("none")).alias("key")) for n, c in names.items()])))
    tally = tally.groupBy("source_id", "what", "key").agg(F.count("*").alias("n"))
    text = lambda n: F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("what") == n, F.concat_ws(":", "key", F.col("n").cast("string")))))).alias(n)
    return join_on(base, tally.groupBy("source_id").agg(*[text(n) for n in names]), ["source_id"])


def medium_balance(obs: DataFrame, degrees: float = 1.0) -> DataFrame:
    """(medium, element or null for all, records, lineages, sources, cells); distinct counts as sums (``distinct``)."""
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    cell = F.when(F.col("lon").isNotNull(), y * 10000 + x).alias("cell")
    rows = obs.groupBy("medium", "element", "lineage", "source_id", cell).agg(F.count("*").alias("records"))
    keys, things = ["medium", "element"], {"lineages": "lineage", "sources": "source_id", "cells": "cell"}
    counted = [rows.groupBy(*keys).agg(F.sum("records").alias("records")), *[distinct_by_keys(rows, keys, c, n, [1, 2]) for n, c in things.items()]]
    return rolled_up(together(counted, keys), keys, ["records"], list(things), [1, 2]).drop("level")


def map_availability(obs: DataFrame, reported: str = "reported_point") -> DataFrame:
    """(dimension, key, canonical, reported_only, unplottable): rows with canonical coordinates, with only reported ones
    (boolean column ``reported``), and with none."""
    located, told = F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.coalesce(F.col(reported), F.lit(False))
    where = F.when(located, "canonical").when(told, "reported_only").otherwise("unplottable")
    rows = obs.select(F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("key"), where.alias("at")) for d in ("element", "medium")])))
    return rows.groupBy("dimension", "key").agg(*[F.count_if(F.col("at") == n).alias(n) for n in ("canonical", "reported_only", "unplottable")])


def element_distribution(obs: DataFrame, bins: int = 16) -> DataFrame:
    """(element, stratum, n, p10, median, p90, bin, in_bin): the largest medium x unit stratum's log10 histogram."""
    keys = ["element", "medium", "unit"]
    v = obs.filter("qualifier = 'reported' and value > 0").select(*keys, "value", F.log10("value").alias("lv"))
    by = v.groupBy(*keys).agg(F.count("*").alias("n"), F.min("lv").alias("lo"), F.max("lv").alias("hi"))
    top = by.withColumn("k", F.row_number().over(Window.partitionBy("element").orderBy(F.desc("n"), "medium", "unit"))).filter("k = 1").drop("k")
    v = join_on(v, top, keys)
    v = join_on(v, quantiles(v, keys, "value", {"p10": 0.1, "median": 0.5, "p90": 0.9}), keys)
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("lv") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"))).otherwise(0)
    return v.withColumn("bin", b).groupBy(*keys, "n", "p10", "median", "p90", "bin").agg(F.count("*").alias("in_bin"))


def coverage_diagnostics(obs: DataFrame) -> DataFrame:
    """(section, key, records, samples, basis_rate, censored): per medium, sample layer and domain."""
    parts = F.array(*[F.struct(F.lit(n).alias("section"), F.coalesce(F.col(c), F.lit("none")).alias("key")) for n, c in (("medium", "medium"), ("layer", "sample_type"), ("domain", "domain"))])
    rows = obs.select(F.inline(parts), "sample_id", "basis", "qualifier")
    once = rows.groupBy("section", "key", "sample_id").agg(F.count("*").alias("n"), F.count("basis").alias("b"), F.count_if(F.col("qualifier") != "reported").alias("c"))
    return once.groupBy("section", "key").agg(F.sum("n").alias("records"), F.count("*").alias("samples"), (F.sum("b") / F.sum("n")).alias("basis_rate"), F.sum("c").alias("censored"))


def region_presets(obs: DataFrame, regions: Mapping[str, Sequence[float]]) -> DataFrame:
    """(region, records, samples, elements, media) of named boxes; a row may be in several."""
    held = F.array_compact(F.array(*[F.when(inside_box(F.col("lon"), F.col("lat"), box), F.lit(n)) for n, box in regions.items()]))
    rows = obs.filter("lon is not null").withColumn("region", F.explode(held))
    return rows.groupBy("region").agg(F.count("*").alias("records"), F.count_distinct("sample_id").alias("samples"), F.concat_ws(",", _set("element")).alias("elements"), F.concat_ws(",", _set("medium")).alias("media"))


def source_confidence(obs: DataFrame, manifest: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Per source: metadata rates, why coordinates and times are absent, means and bands of the named scores, and the
    link of its manifest row (none if it has no row)."""
    rate = lambda c: F.avg(F.col(c).isNotNull().cast("double"))
    band = lambda c: F.when(F.col(c) >= 0.8, "high").when(F.col(c) >= 0.6, "medium").otherwise("low")
    absent = F.array_compact(F.array(F.when(F.col("lon").isNull(), "no_coordinate"), F.when(F.col("sampled_at").isNull(), "no_time"), F.when(F.col("basis").isNull(), "no_basis"), F.when(F.col("license").isNull(), "no_license")))
    g = obs.groupBy("source_id").agg(
        F.count("*").alias("records"), rate("license").alias("license_rate"), rate("lon").alias("coordinate_rate"), rate("basis").alias("basis_rate"), rate("sampled_at").alias("time_rate"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.flatten(F.collect_set(absent))))).alias("absent"), *[F.avg(c).alias(f"{c}_mean") for c in scores],
        *[F.count_if(band(c) == b).alias(f"{c}_{b}") for c in scores for b in ("high", "medium", "low")],
    )
    return g.join(manifest.select("source_id", "link"), "source_id", "left")


def source_independence(obs: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Per medium: sources, lineages, analytes with one and with several sources, requested ones missing, status."""
    per = obs.groupBy("medium", "element").agg(F.count_distinct("source_id").alias("s"))
    el = per.groupBy("medium").agg(F.count_if(F.col("s") == 1).alias("single_source"), F.count_if(F.col("s") > 1).alias("multi_source"), F.collect_set("element").alias("have"))
    so = obs.groupBy("medium").agg(F.count_distinct("source_id").alias("sources"), F.count_distinct("lineage").alias("lineages"))
    missing = F.concat_ws(",", F.array_sort(F.array_except(F.array(*[F.lit(r) for r in requested]), "have")))
    status = F.when(F.col("lineages") >= 2, "independent").when(F.col("sources") >= 2, "shared_lineage").otherwise("single_source")
    return so.join(el, "medium").select("medium", "sources", "lineages", "single_source", "multi_source", missing.alias("missing"), status.alias("status"))


def request_dimension_coverage(obs: DataFrame, request: Mapping[str, Sequence[str]]) -> DataFrame:
    """(dimension, requested, observed, missing) against one request."""
    seen = obs.agg(*[F.collect_set(d).alias(d) for d in request])
    want = {d: F.array(*[F.lit(x) for x in v]) for d, v in request.items()}
    text = lambda a: F.concat_ws(",", F.array_sort(a))
    return seen.select(F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), text(want[d]).alias("requested"), text(F.array_intersect(want[d], F.col(d))).alias("observed"), text(F.array_except(want[d], F.col(d))).alias("missing")) for d in request])))


def claim_recompute(obs: DataFrame, claims: DataFrame) -> DataFrame:
    """(claim, claimed, actual, status): counts taken anew and compared with what is claimed."""
    actual = obs.agg(
        F.count("*").alias("records"), F.count_distinct("sample_id").alias("samples"), F.count_distinct("source_id").alias("sources"), F.count_if(F.col("qualifier") != "reported").alias("censored"), F.count("lon").alias("with_coordinates")
    )
    names = ("records", "samples", "sources", "censored", "with_coordinates")
    rows = actual.select(F.inline(F.array(*[F.struct(F.lit(n).alias("claim"), F.col(n).alias("actual")) for n in names])))
    status = F.when(F.col("actual").isNull(), "unknown_claim").when(F.col("actual") == F.col("claimed"), "match").otherwise("mismatch")
    return claims.join(rows, "claim", "left").select("claim", "claimed", "actual", status.alias("status"))


def backlog_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("status", "owner", "code").agg(F.count("*").alias("n"))


def cell_reason(x: Column) -> Column:
    """numeric, censored ('<'), missing or invalid."""
    text = F.nullif(F.trim(x), F.lit(""))
    return F.when(text.isNull(), "missing").when(text.startswith("<"), "censored").when(text.try_cast("double").isNotNull(), "numeric").otherwise("invalid")


def value_profile(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: numeric, censored, missing and invalid cells, least and greatest number."""
    cells = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("element"), cell_reason(F.col(c)).alias("why"), F.trim(F.col(c)).alias("x")) for c in columns])))
    num = F.when(F.col("why") == "numeric", F.col("x").try_cast("double"))
    return cells.groupBy("element").agg(*[F.count_if(F.col("why") == n).alias(n) for n in ("numeric", "censored", "missing", "invalid")], F.min(num).alias("least"), F.max(num).alias("greatest"))


def row_reasons(wide: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(key, reasons): the sorted reasons other than numeric among a row's cells."""
    found = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.nullif(cell_reason(F.col(c)), F.lit("numeric")) for c in columns]))))
    return wide.select(key, F.concat_ws(",", found).alias("reasons"))


def lab_metadata_profile(meta: DataFrame) -> DataFrame:
    """Per element: accredited rows, distinct batches, distinct limits as text."""
    return meta.groupBy("element").agg(F.count_if("accredited").alias("accredited"), F.count_distinct("batch_id").alias("batches"), F.count_distinct("censor_limit").alias("limits"))


def quality_flag_audit(rows: DataFrame) -> DataFrame:
    """Per analyte and flag: rows, stations, cruises, depth, time and value ranges."""
    return rows.groupBy("element", "flag").agg(
        F.count("*").alias("n"), F.count_distinct("station").alias("stations"), F.count_distinct("cruise").alias("cruises"), F.min("depth").alias("shallowest"), F.max("depth").alias("deepest"),
        F.min("t").alias("first"), F.max("t").alias("last"), F.min("value").alias("least"), F.max("value").alias("greatest"),
    )


def discovery_candidates(cohorts: DataFrame, gaps: DataFrame, least: int = 50, alone: int = 500, shared: int = 200) -> DataFrame:
    """(kind, key, score) from usable cohorts with ``least`` quantified samples, and ``gaps`` (region, ...).

    T2: an element, medium and sample type measured by several methods; T3: an element and medium with ``alone`` samples
    or more, all from one and the same source; T4: gaps of a region; T5: an element with ``shared`` samples in soil and
    in water, or else in sediment. Scores are sums of quantified samples, for T4 gaps.
    """
    usable, samples = usable_cohorts(cohorts, least), F.sum("quantified_samples")
    t2 = usable.groupBy("element", "medium", "sample_type").agg(F.count_distinct(F.coalesce("method_family", F.lit(""))).alias("m"), samples.alias("score")).filter("m >= 2")
    t3 = usable.groupBy("element", "medium").agg(samples.alias("score"), F.max("sources").alias("sources"), F.count_distinct("top_source").alias("tops"))
    t3 = t3.filter((F.col("score") >= alone) & (F.col("sources") == 1) & (F.col("tops") == 1))
    t4 = gaps.groupBy(F.coalesce("region", F.lit("unknown")).alias("region")).agg(F.count("*").alias("score"))
    in_ = lambda m: F.coalesce(F.sum(F.when(F.col("medium") == m, F.col("quantified_samples"))), F.lit(0)).alias(m)
    t5 = usable.groupBy("element").agg(*[in_(m) for m in ("soil", "water", "sediment")]).filter((F.col("soil") >= shared) & (F.greatest("water", "sediment") >= shared))
    partner = F.when(F.col("water") >= shared, "water").otherwise("sediment")
    t5 = t5.select("element", partner.alias("partner"), (F.col("soil") + F.when(F.col("water") >= shared, F.col("water")).otherwise(F.col("sediment"))).alias("score"))
    as_ = lambda df, kind, *key: df.select(F.lit(kind).alias("kind"), F.concat_ws("|", *key).alias("key"), "score")
    return as_(t2, "T2", "element", "medium", "sample_type").union(as_(t3, "T3", "element", "medium")).union(as_(t4, "T4", "region")).union(as_(t5, "T5", "element", F.lit("soil"), "partner"))


def sampling_priority(gaps: DataFrame, cohorts: DataFrame) -> DataFrame:
    """(priority, task, key, box): gap zones first, then cohorts of one source, the largest first; numbered by ranges."""
    box = lambda: F.concat_ws(",", *[F.round(c, 2).cast("string") for c in ("west", "south", "east", "north")])
    g = gaps.select(F.lit(1).alias("kind"), F.lit("fill_zone").alias("task"), F.concat_ws("|", "view", "key", "zone").alias("key"), box().alias("box"), F.lit(0).cast("bigint").alias("n"))
    c = cohorts.filter("sources = 1").select(F.lit(2), F.lit("second_source"), F.concat_ws("|", *COHORT), box(), "quantified")
    both = g.union(c)
    return numbered(both, ["kind", F.desc("n"), "key"], "priority").select(F.col("priority").cast("int"), "task", "key", "box")


def readiness_criteria(obs: DataFrame, targets: DataFrame) -> DataFrame:
    """(criterion, actual, status) against targets (criterion, least, warn): pass at ``least``, warning at ``warn``."""
    big = obs.groupBy("source_id").agg(F.count("*").alias("n")).agg((1 - F.max("n") / F.sum("n")).alias("source_balance"))
    med = obs.groupBy("medium").agg(F.count("*").alias("n"), F.count_distinct("lineage").alias("l")).agg((F.min("n") / F.max("n")).alias("medium_balance"), F.min("l").cast("double").alias("lineages_per_medium"))
    elements = obs.groupBy("element").agg(F.count("*").alias("n")).agg((F.min("n") / F.max("n")).alias("element_balance"))
    groups = obs.groupBy("element", "medium", "unit").agg(F.count("*").alias("n"), F.count_if((F.col("qualifier") == "reported") & (F.col("value") > 0)).alias("q"))
    background = groups.agg((F.sum(F.when((F.col("q") >= 8) & (F.col("q") >= 0.7 * F.col("n")), F.col("n")).otherwise(0)) / F.sum("n")).alias("outlier_background"))
    one = obs.agg(
        F.count("*").cast("double").alias("records"), F.count_distinct("sample_id").cast("double").alias("samples"), F.count_distinct("source_id").cast("double").alias("sources"), F.avg(F.col("license").isNotNull().cast("double")).alias("provenance"),
        F.avg(F.col("basis").isNotNull().cast("double")).alias("method"), F.avg(F.col("lithology").isNotNull().cast("double")).alias("geology"), F.avg(F.col("lon").isNotNull().cast("double")).alias("mappable"),
    )
    names = ("records", "samples", "sources", "provenance", "method", "geology", "mappable")
    rows = tall(one, names, "criterion", "actual").union(tall(big, ["source_balance"], "criterion", "actual")).union(tall(med, ["medium_balance", "lineages_per_medium"], "criterion", "actual"))
    rows = rows.union(tall(elements, ["element_balance"], "criterion", "actual")).union(tall(background, ["outlier_background"], "criterion", "actual"))
    status = F.when(F.col("actual").isNull(), "unassessable").when(F.col("actual") >= F.col("least"), "pass").when(F.col("actual") >= F.col("warn"), "warning").otherwise("fail")
    return targets.join(rows, "criterion", "left").select("criterion", "actual", status.alias("status"))


def table_summary(obs: DataFrame) -> DataFrame:
    return obs.agg(
        F.concat_ws(",", _set("element")).alias("elements"), F.concat_ws(",", _set("medium")).alias("media"), F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"),
        F.avg(F.col("lon").isNotNull().cast("double")).alias("coordinate_rate"), F.avg(F.col("value").isNotNull().cast("double")).alias("standardized_rate"),
    )


def comparability_partitions(raw: DataFrame, obs: DataFrame, raw_keys: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows per comparability key before and after standardization; null keys match."""
    a = raw.groupBy(*[F.col(r).alias(k) for r, k in zip(raw_keys, keys)]).agg(F.count("*").alias("before"))
    b = obs.groupBy(*keys).agg(F.count("*").alias("after"))
    on = a[keys[0]].eqNullSafe(b[keys[0]])
    for k in keys[1:]:
        on = on & a[k].eqNullSafe(b[k])
    return a.join(b, on, "full").select(*[F.coalesce(a[k], b[k]).alias(k) for k in keys], F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
