"""Duplicates, laboratory batches, robust outliers, and where outliers cluster."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import fresh, scratch
from ..functions.standardize import confidence_score, flags
from ..sources.storage import written
from .bracket import brackets, median_and_deviation, summary
from .ranking import behind, join_on, least_from_above, ranked_values
from .rows import repeated

CENSORED = ("lt", "le", "gt", "ge", "bdl", "loq", "nd", "trace")
POLICY = {"recovery_low": 80.0, "recovery_high": 120.0, "blank_max": 5.0, "rpd_max": 20.0, "unit": "mg/kg"}


#: What tells two measurements apart, beside the sample; and what stands for a sample that has no identity.
MEASUREMENT = ("source_id", "replicate_group_id", "element_or_analyte", "species_or_oxide", "value", "unit", "method_family", "analytical_method", "measurement_basis", "latitude", "longitude")
CONTEXT = ("latitude", "longitude", "sampled_at", "sample_depth_min_m", "sample_depth_max_m", "material", "sample_type", "soil_horizon", "sediment_environment", "water_fraction", "grain_fraction")


def measurement_identity(obs: DataFrame) -> list[Column]:
    """The twelve parts of a measurement's identity. A sample without identity group or id is told by its context;
    columns that the table lacks are null."""
    have = {c.lower() for c in obs.columns}
    col = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    blank = lambda c: F.nullif(col(c).cast("string"), F.lit(""))
    named = F.coalesce(blank("sample_identity_group"), blank("sample_id"))
    context = F.struct(*[col(c).cast("string").alias(c) for c in CONTEXT])
    sample = F.when(named.isNotNull(), F.concat(F.lit("id:"), named)).otherwise(F.concat(F.lit("context:"), F.to_json(context)))
    return [sample, *[col(c) for c in MEASUREMENT]]


def duplicate_candidates(obs: DataFrame, keys: Sequence[str | Column] | None = None, into: str = "duplicate", stored: bool = False) -> DataFrame:
    """Flag every member of a group with more than one row; none is dropped, and null is a key value like others.

    ``keys`` default to ``measurement_identity``. Rows are counted by a hash of eight bytes, and only those that share one by
    a digest of the keys, so neither whole rows nor their keys are shuffled. What is repeated is written to the shared folder:
    Spark knows how little it is when the rows meet it. They are read three times, so they are written before; ``stored`` says
    that they are a stored table already.
    """
    if not stored:
        obs = written(obs)
    parts = [p.cast("string") for p in (measurement_identity(obs) if keys is None else [F.col(k) if isinstance(k, str) else k for k in keys])]
    digest = F.sha2(F.to_json(F.struct(*[p.alias(f"c{i}") for i, p in enumerate(parts)])), 256)
    short, full, many = fresh([*obs.columns, into], "short", "full", "many")
    keyed = obs.withColumn(short, F.xxhash64(*parts))
    again = keyed.join(repeated(keyed, short), short, "left_semi").select(short, digest.alias(full)).groupBy(short, full).agg(F.count("*").alias("n")).filter("n > 1")
    joined = keyed.join(written(again.groupBy(short).agg(F.collect_set(full).alias(many))), short, "left")
    kept = [F.col(f"`{c}`") for c in obs.columns if c.lower() != into.lower()]
    return joined.select(*kept, F.when(F.col(many).isNotNull(), F.array_contains(F.col(many), digest)).otherwise(False).alias(into))


def exclusion(obs: DataFrame, gate: bool = False, value: str = "value") -> Column:
    """Why a row can't be screened, first reason first; null if it can."""
    rules = []
    if gate:
        rules += [("batch_qc_failed", F.col("batch_status").eqNullSafe("fail")), ("batch_qc_incomplete", ~F.col("batch_status").eqNullSafe("pass"))]
    if "duplicate" in obs.columns:
        rules.append(("duplicate_candidate", F.col("duplicate")))
    unusable = F.col(value).isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    rules += [("censored", F.col("qualifier").isin(*CENSORED)), ("not_standardized", unusable), ("non_positive", F.col(value) <= 0)]
    out = F.lit(None).cast("string")
    for name, hit in reversed(rules):
        out = F.when(hit, name).otherwise(out)
    return out


def anomaly_group_report(obs: DataFrame, group_by: Sequence[str], min_group: int = 8, min_quantified: float = 0.7, gate: bool = False) -> DataFrame:
    """One row per comparable group: counts, fractions, status, log10 median and MAD.

    Two scans of ``obs``, neither of which shuffles its rows: counts and a summary of every group, then exact medians and
    deviations within the summary's brackets. The report, a row a group, is written to the shared folder.
    """
    why = exclusion(obs, gate)
    names = ("censored", "not_standardized", "non_positive", "duplicates", "batch_excluded")
    held = {"duplicates": ("duplicate_candidate",), "batch_excluded": ("batch_qc_failed", "batch_qc_incomplete")}
    marked, keys, named = behind(obs.select(*[F.col(f"`{c}`") for c in group_by], why.alias("excluded why"), F.when(why.isNull(), F.log10("value")).alias("log of value")), group_by)
    groups = marked.groupBy(*keys).agg(
        F.count("*").alias("records_total"), F.count_if(F.col("excluded why").isNull()).alias("records_used"), *[F.count_if(F.col("excluded why").isin(*held.get(n, (n,)))).alias(n) for n in names],
        summary(F.col("log of value")).alias("points"),
    )
    groups = written(groups.withColumn("bracket", brackets(F.col("points"))).drop("points"))
    found = median_and_deviation(marked, groups.withColumn("n", F.col("records_used")), keys, "log of value")
    out = join_on(groups.drop("bracket"), found, keys, "left").withColumnsRenamed({"median": "log10_median", "mad": "log10_mad"})
    independent = F.col("records_total") - F.col("duplicates") - F.col("batch_excluded")
    out = out.withColumn("independent", independent).withColumn("quantified_fraction", F.when(F.col("independent") > 0, F.col("records_used") / F.col("independent")).otherwise(0.0))
    status = (
        F.when(F.col("independent") < min_group, "insufficient_group_size").when(F.col("quantified_fraction") < min_quantified, "insufficient_quantified_fraction")
        .when(F.col("records_used") < min_group, "insufficient_usable_group_size").when(F.col("log10_mad") == 0, "zero_dispersion").otherwise("analyzed")
    )
    return named(written(out.withColumn("status", status)))


def robust_anomalies(obs: DataFrame, group_by: Sequence[str], min_group: int = 8, z: float = 3.5, min_quantified: float = 0.7, gate: bool = False, stored: bool = False) -> DataFrame:
    """Rows whose log10 value lies ``z`` or more robust deviations from their group's median; adds robust_z, direction.

    A third scan joins the rows with the report of ``anomaly_group_report``. The rows are written to the shared folder before,
    so that joins behind them are not shuffled for each scan: give only columns that the result shall have. ``stored`` says
    that they are a stored table already."""
    if not stored:
        obs = written(obs)
    report = anomaly_group_report(obs, group_by, min_group, min_quantified, gate).filter("status = 'analyzed'")
    obs = obs.drop("robust_z", "direction")
    log, why, z_score, median, mad = fresh(obs, "log", "why", "z", "median", "mad")
    usable = obs.withColumns({log: F.log10("value"), why: exclusion(obs, gate)}).filter(F.col(why).isNull())
    scored = join_on(usable, report.select(*group_by, F.col("log10_median").alias(median), F.col("log10_mad").alias(mad)), group_by)
    scored = scored.withColumn(z_score, 0.67448975 * (F.col(log) - F.col(median)) / F.col(mad)).filter(F.abs(F.col(z_score)) >= z)
    return scored.select(*[F.col(f"`{c}`") for c in obs.columns], F.col(z_score).alias("robust_z"), F.when(F.col(z_score) > 0, "high").otherwise("low").alias("direction"))


def robust_scores(obs: DataFrame, report: DataFrame, group_by: Sequence[str], z: float = 3.5, gate: bool = False, value: str = "value") -> DataFrame:
    """Every row of ``obs`` with robust_z and direction, null unless it is an outlier by the ``report`` of
    ``anomaly_group_report``. The report is a row a group, so rows meet it where they lie."""
    obs = obs.drop("robust_z", "direction")
    median, mad, score = fresh([*obs.columns, "robust_z", "direction"], "median", "mad", "score")
    known = report.filter("status = 'analyzed'").select(*group_by, F.col("log10_median").alias(median), F.col("log10_mad").alias(mad))
    scored = join_on(obs, known, group_by, "left").withColumn(score, F.when(exclusion(obs, gate, value).isNull(), 0.67448975 * (F.log10(value) - F.col(median)) / F.col(mad)))
    far = F.abs(F.col(score)) >= z
    return scored.select(*[F.col(f"`{c}`") for c in obs.columns], F.when(far, F.col(score)).alias("robust_z"), F.when(far, F.when(F.col(score) > 0, "high").otherwise("low")).alias("direction"))


# Lanczos coefficients, g = 7.
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def log_factorial(n: Column) -> Column:
    """ln n! by the Lanczos series, about 1e-14 relative; Spark has no lgamma."""
    total: Column = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (n + i)
    t = n + 7.5
    return 0.5 * math.log(2 * math.pi) + (n + 0.5) * F.ln(t) - t + F.ln(total)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric_survival(df: DataFrame, successes: str, population: str, population_successes: str, draws: str, into: str = "p_value", most: int = 4096) -> DataFrame:
    """Add P[X >= successes] of the hypergeometric distribution.

    The asked tail is summed where it is the smaller one, so small p values keep their digits; elsewhere the other one
    is taken from 1. Terms follow from each other by a ratio that falls with the distance from the mode. A row has as
    many terms as the tail, or 12 standard deviations and 60, or ``most``, whichever is least; the geometric bound of
    what is left out is added, so p errs upwards, by less than 1e-9 of itself up to a deviation of ``most`` / 12.
    """
    x, n, k, m = (F.col(c).cast("double") for c in (successes, population, population_successes, draws))
    low, high = F.greatest(F.lit(0.0), m - (n - k)), F.least(m, k)
    upper = x > (m + 1) * (k + 1) / (n + 2)  # beyond the mode, the asked tail is the smaller one
    at = F.when(upper, x).otherwise(x - 1)
    log_first = log_choose(k, at) + log_choose(n - k, m - at) - log_choose(n, m)
    deviation = F.sqrt(m * (k / n) * (1 - k / n) * (n - m) / F.greatest(n - 1, F.lit(1.0)))
    left = F.greatest(F.when(upper, high - at).otherwise(at - low), F.lit(0.0))
    terms = F.least(left, F.ceil(12 * deviation) + 60.0, F.lit(float(most)))

    def ratio(i: Column) -> Column:
        """Of the next term, away from the mode, to the term at ``i``."""
        up = (k - i) * (m - i) / ((i + 1) * (n - k - m + i + 1))
        down = i * (n - k - m + i) / ((k - i + 1) * (m - i + 1))
        return F.when(upper, up).otherwise(down)

    def add(state: Column, j: Column) -> Column:
        i = F.when(upper, at + j).otherwise(at - j)
        return F.struct((state["t"] * F.coalesce(ratio(i), F.lit(0.0))).alias("t"), (state["s"] + state["t"]).alias("s"))

    def close(state: Column) -> Column:
        after = ratio(F.when(upper, at + terms + 1).otherwise(at - terms - 1))
        return state["s"] + F.when((terms < left) & (after < 1), state["t"] / (1 - after)).otherwise(0.0)

    start = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    total = F.exp(log_first) * F.aggregate(F.sequence(F.lit(0), terms.cast("int")), start, add, close)
    p = F.when(x <= low, 1.0).when(x > high, 0.0).when(upper, total).otherwise(1.0 - total)
    return df.withColumn(into, F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)))


def benjamini_hochberg(df: DataFrame, p_col: str, into: str = "q_value") -> DataFrame:
    """Add step-up q values over all rows. Equal p values share a rank; running counts and minima go over buckets of p,
    so no task sees all hypotheses."""
    df = written(df)  # hypotheses, few next to the measurements behind them, are read three times
    q = least_from_above(ranked_values(df, [], p_col), [], F.col("v") * F.col("n") / (F.col("before") + F.col("k")), "q")
    return join_on(df, q.select(F.col("v").alias(p_col), F.least(F.lit(1.0), "q").alias(into)), [p_col], "left")


def cell_index(lon: Column, lat: Column, degrees: float) -> tuple[Column, Column]:
    """(column, row) of a grid cell; +180 and +90 belong to the last cells."""
    clamp = lambda v, top: F.least(F.lit(top - 1), F.greatest(F.lit(0), F.floor(v / degrees).cast("int")))
    return clamp(lon + 180, round(360 / degrees)), clamp(lat + 90, round(180 / degrees))


def spatial_anomaly_cells(obs: DataFrame, flagged: DataFrame, group_by: Sequence[str], degrees: float = 2.0, min_samples: int = 5, min_candidates: int = 2, alpha: float = 0.1) -> DataFrame:
    """Group x direction x cell with more candidates than chance: hypergeometric p, q by Benjamini-Hochberg, enrichment.

    ``obs`` are the screened rows, ``flagged`` (direction, lon, lat and the group) the candidates among them: both are
    counted by cell, so rows meet no candidate by their ids.
    """
    x, y = cell_index(F.col("lon"), F.col("lat"), degrees)
    placed = lambda df, n, side: df.filter("lon is not null and lat is not null").select(*group_by, x.alias("cell_x"), y.alias("cell_y"), F.lit(n).cast("bigint").alias("n"), side.alias("direction"))
    rows = placed(obs, 1, F.lit(None).cast("string")).union(placed(flagged, 0, F.col("direction")))
    cells = rows.groupBy(*group_by, "cell_x", "cell_y").agg(F.sum("n").alias("n_cell"), F.count_if(F.col("direction") == "high").alias("high"), F.count_if(F.col("direction") == "low").alias("low"))
    w = Window.partitionBy(*group_by)
    cells = cells.withColumns({"n_group": F.sum("n_cell").over(w), "g_high": F.sum("high").over(w), "g_low": F.sum("low").over(w)})
    sides = F.explode(F.array(*[F.struct(F.lit(d).alias("direction"), F.col(d).alias("k_cell"), F.col(f"g_{d}").alias("k_group")) for d in ("high", "low")]))
    tests = cells.withColumn("s", sides).select(*group_by, "cell_x", "cell_y", "n_cell", "n_group", "s.*").filter((F.col("n_cell") >= min_samples) & (F.col("k_group") > 0))
    # Few rows with much work each: without a fixed number, small partitions would be merged into one task.
    tests = tests.repartition(int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tested = benjamini_hochberg(hypergeometric_survival(tests, "k_cell", "n_group", "k_group", "n_cell"), "p_value")
    inside, outside = F.col("k_cell") / F.col("n_cell"), (F.col("k_group") - F.col("k_cell")) / F.nullif(F.col("n_group") - F.col("n_cell"), F.lit(0))
    kept = tested.withColumns({"rate_inside": inside, "rate_outside": outside}).filter((F.col("q_value") <= alpha) & (F.col("k_cell") >= min_candidates) & (F.col("rate_inside") > F.coalesce("rate_outside", F.lit(0.0))))
    return kept


def batch_qc(rows: DataFrame, policy: Mapping = POLICY) -> DataFrame:
    """Per batch: worst recovery, largest blank, worst duplicate difference, each check's outcome, and the decision."""
    recovery = F.when(F.col("qc_type") == "CRM", 100 * F.col("value") / F.col("certified_value"))
    single = rows.groupBy("batch_id").agg(
        F.max_by(recovery, F.abs(recovery - 100)).alias("worst_recovery"), F.max(F.when(F.col("qc_type") == "BLANK", F.col("value"))).alias("max_blank"),
        F.bool_and(F.when(F.col("qc_type") == "CRM", recovery.between(policy["recovery_low"], policy["recovery_high"]))).alias("crm_ok"),
    )
    pairs = rows.filter("qc_type = 'DUPLICATE'").groupBy("batch_id", "pair_id").agg(F.min("value").alias("a"), F.max("value").alias("b"), F.count("*").alias("n"))
    rpd = F.when((F.col("n") == 2) & (F.col("a") + F.col("b") > 0), 200 * (F.col("b") - F.col("a")) / (F.col("a") + F.col("b")))
    dup = pairs.groupBy("batch_id").agg(F.max(rpd).alias("worst_rpd"))
    out = single.join(dup, "batch_id", "left")
    blank_ok, dup_ok = F.col("max_blank") <= policy["blank_max"], F.col("worst_rpd") <= policy["rpd_max"]
    whole = F.col("crm_ok").isNotNull() & F.col("max_blank").isNotNull() & F.col("worst_rpd").isNotNull()
    failed = ~F.coalesce(F.col("crm_ok"), F.lit(True)) | ~F.coalesce(blank_ok, F.lit(True)) | ~F.coalesce(dup_ok, F.lit(True))
    return out.withColumns({"blank_ok": blank_ok, "duplicate_ok": dup_ok, "status": F.when(failed, "fail").when(whole, "pass").otherwise("incomplete")})


@scratch("_v", "violation")
def batch_qc_validate(rows: DataFrame, policy: Mapping = POLICY) -> DataFrame:
    """(batch_id, qc_id, violation): repeated ids, reference materials without a value, duplicates without a pair, units."""
    again = F.count("*").over(Window.partitionBy("batch_id", "qc_id"))
    checks = (
        ("duplicate_id", again > 1), ("crm_without_certified_value", (F.col("qc_type") == "CRM") & F.col("certified_value").isNull()),
        ("duplicate_without_pair", (F.col("qc_type") == "DUPLICATE") & F.col("pair_id").isNull()), ("unit_mismatch", F.col("unit") != policy["unit"]),
        ("unknown_type", ~F.col("qc_type").isin("CRM", "BLANK", "DUPLICATE")),
    )
    made = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks]))
    return rows.withColumn("_v", made).select("batch_id", "qc_id", F.explode("_v").alias("violation"))


@scratch("_s")
def apply_batch_gate(obs: DataFrame, acceptance: DataFrame) -> DataFrame:
    """Add batch_status, batch_disposition and batch_flags; a row without batch, or whose batch has no decision, is
    incomplete. Where the table has qc_flags they get these flags too, and where it has a confidence, it is scored anew.

    The decisions are written before: Spark then knows how few they are and need not shuffle the measurements by batch."""
    decided = obs.join(written(acceptance.select("batch_id", F.col("status").alias("_s"))), "batch_id", "left")
    status = F.coalesce("_s", F.lit("incomplete"))
    added = flags(("MISSING_ANALYSIS_BATCH_ID", F.col("batch_id").isNull()), ("BATCH_QC_FAILED", status == "fail"), ("BATCH_QC_NOT_EVALUATED", status == "incomplete"))
    out = decided.withColumns({"batch_status": status, "batch_disposition": F.when(status == "pass", "accept_for_scientific_analysis").otherwise("exclude_batch_and_investigate"), "batch_flags": added}).drop("_s")
    if "qc_flags" in obs.columns:
        out = out.withColumn("qc_flags", F.array_distinct(F.concat("qc_flags", "batch_flags")))
    return confidence_score(out) if "confidence" in obs.columns else out


def batch_gate_check(stored: DataFrame, acceptance: DataFrame) -> DataFrame:
    """Rows whose stored batch_status is not what the decisions say."""
    expected = written(acceptance.select("batch_id", F.col("status").alias("expected")))
    return stored.join(expected, "batch_id", "left").withColumn("expected", F.coalesce("expected", F.lit("incomplete"))).filter(~F.col("batch_status").eqNullSafe(F.col("expected")))


def anomaly_recompute_check(obs: DataFrame, claimed: DataFrame, group_by: Sequence[str], tolerance: float = 1e-6, stored: bool = False) -> DataFrame:
    """(record_id, problem): claims that the screening doesn't give, misses, and scores that differ. ``stored`` is that of
    ``robust_anomalies``."""
    obs = obs.select(*[c for c in obs.columns if c.lower() in {"record_id", "value", "qualifier", "duplicate", *(g.lower() for g in group_by)}])
    found = robust_anomalies(obs, group_by, stored=stored).select("record_id", F.col("robust_z").alias("_z"))
    both = found.join(claimed.select("record_id", "robust_z"), "record_id", "full")
    problem = F.when(F.col("_z").isNull(), "not_an_anomaly").when(F.col("robust_z").isNull(), "not_claimed").when(F.abs(F.col("_z") - F.col("robust_z")) > tolerance, "score_differs")
    return both.select("record_id", problem.alias("problem")).filter("problem is not null")


def unit_rederive_check(obs: DataFrame, factors: Mapping[str, float], tolerance: float = 1e-9) -> DataFrame:
    """Rows whose normalized value is not the original times its unit's factor, or whose unit doesn't suit the medium."""
    factor = F.lit(None).cast("double")
    for unit, f in factors.items():
        factor = F.when(F.col("original_unit") == unit, f).otherwise(factor)
    want = F.col("original_value") * factor
    off = F.abs(want - F.col("value")) > tolerance * F.greatest(F.abs(want), F.abs("value"))
    flip = ((F.col("medium") == "water") & (F.col("unit") == "mg/kg")) | ((F.col("medium") != "water") & (F.col("unit") == "ug/L"))
    return obs.withColumn("problem", F.when(flip, "phase_flip").when(off, "value_differs")).filter("problem is not null")


def censor_guard_check(obs: DataFrame, flagged: DataFrame) -> DataFrame:
    """Censored rows with a value, or among the candidates."""
    censored = obs.filter(F.col("qualifier").isin(*CENSORED))
    valued = censored.filter("value is not null").select("record_id", F.lit("censored_with_value").alias("problem"))
    listed = censored.join(flagged.select("record_id").distinct(), "record_id", "left_semi").select("record_id", F.lit("censored_listed").alias("problem"))
    return valued.unionByName(listed)


def database_contract_check(obs: DataFrame) -> DataFrame:
    """(rule, violations) over the whole table: ids, values and limits, coordinates, addresses, a method or the reason for
    none but not both, and an accuracy status wherever there is a place."""
    again = obs.groupBy("record_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))
    rules = {
        "null_id": F.col("record_id").isNull(), "value_and_limit": F.col("value").isNotNull() & F.col("censor_limit").isNotNull(),
        "half_coordinate": F.col("lon").isNull() != F.col("lat").isNull(), "out_of_range": ~F.coalesce(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90), F.lit(True)),
        "no_license": F.col("license").isNull(), "no_basis": F.col("basis").isNull(), "invalid_url": F.col("url").isNotNull() & ~F.col("url").rlike("^https?://[^/ ]+"),
        "method_and_reason": F.col("method_family").isNotNull() & F.col("method_missing_reason").isNotNull(), "no_method_no_reason": F.col("method_family").isNull() & F.col("method_missing_reason").isNull(),
        "accuracy_unaccounted": F.col("lon").isNotNull() & F.col("coordinate_accuracy_status").isNull(), "accuracy_without_place": F.col("lon").isNull() & (F.col("coordinate_accuracy_status") != "not_applicable"),
    }
    sums = obs.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    tall = sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])))
    return tall.union(again.select(F.lit("repeated_id"), "n"))
