"""Paired and comparative statistics. Every pairing is a grouped conditional aggregate, never a self join of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import scratch
from .ranking import behind, join_on, mean_ranks, quantiles, ranked_values, values_at


def element_pair(obs: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """keys, x_value, y_value, status: paired, x_only, y_only, or ambiguous where an element has several values."""
    rows = obs.filter(F.col("element").isin(x, y) & (F.col("qualifier") == "reported") & (F.col("value") > 0))
    v = lambda e: F.when(F.col("element") == e, F.col("value"))
    g = rows.groupBy(*keys).agg(F.count(v(x)).alias("nx"), F.count(v(y)).alias("ny"), F.max(v(x)).alias("x_value"), F.max(v(y)).alias("y_value"))
    status = F.when((F.col("nx") > 1) | (F.col("ny") > 1), "ambiguous").when(F.col("ny") == 0, "x_only").when(F.col("nx") == 0, "y_only").otherwise("paired")
    return g.withColumn("status", status).drop("nx", "ny")


def element_comparison_stats(pairs: DataFrame, keys: Sequence[str], least: int = 8) -> DataFrame:
    """Per key: pairs, Spearman rho (``least`` pairs or more), log10 medians, counts in the quadrants around them."""
    p = pairs.filter("status = 'paired'").select(*keys, F.log10("x_value").alias("lx"), F.log10("y_value").alias("ly"))
    ranked = mean_ranks(mean_ranks(p, keys, "lx", "rx"), keys, "ly", "ry")
    rho = ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.corr("rx", "ry").alias("rho")).withColumn("rho", F.when(F.col("n") >= least, F.col("rho")))
    med = join_on(quantiles(p, keys, "lx", {"median_x": 0.5}), quantiles(p, keys, "ly", {"median_y": 0.5}), keys)
    hi = (F.col("lx") >= F.col("median_x")), (F.col("ly") >= F.col("median_y"))
    quad = join_on(p, med, keys).groupBy(*keys).agg(F.count_if(hi[0] & hi[1]).alias("high_high"), F.count_if(~hi[0] & ~hi[1]).alias("low_low"), F.count_if(hi[0] & ~hi[1]).alias("high_low"), F.count_if(~hi[0] & hi[1]).alias("low_high"))
    return join_on(join_on(rho, med, keys), quad, keys)


@scratch("_side")
def median_pair(obs: DataFrame, keys: Sequence[str], side: Column, a: str, b: str) -> DataFrame:
    """keys, a_median, b_median, ratio, log2_ratio where both sides of ``side`` have positive values.

    ``keys`` name a sample or a site: its own measurements are few, so its median is a grouped aggregate.
    """
    rows = obs.withColumn("_side", side).filter(F.col("_side").isin(a, b) & (F.col("qualifier") == "reported") & (F.col("value") > 0))
    v = lambda s: F.when(F.col("_side") == s, F.col("value"))
    g = rows.groupBy(*keys).agg(F.median(v(a)).alias("a_median"), F.median(v(b)).alias("b_median")).filter("a_median is not null and b_median is not null")
    return g.withColumns({"ratio": F.col("b_median") / F.col("a_median"), "log2_ratio": F.log2(F.col("b_median") / F.col("a_median"))})


def method_pair(obs: DataFrame, element: str, family_a: str, family_b: str) -> DataFrame:
    """Same-sample medians under two methods."""
    return median_pair(obs.filter(F.col("element") == element), ["sample_id"], F.col("method_family"), family_a, family_b)


def layer_pair(obs: DataFrame, element: str, surface: str, deep: str, digits: int = 2) -> DataFrame:
    """Surface and deep medians at one place, coordinates rounded."""
    rows = obs.filter((F.col("element") == element) & F.col("lon").isNotNull()).withColumns({"site_lon": F.round("lon", digits), "site_lat": F.round("lat", digits)})
    return median_pair(rows, ["site_lon", "site_lat"], F.col("sample_type"), surface, deep)


def survey_colocation(obs_a: DataFrame, obs_b: DataFrame, degrees: float, threshold: float) -> DataFrame:
    """Cells that two surveys share: medians, ratio, agreement within a factor of 2, both above the threshold."""

    def cells(df: DataFrame, name: str) -> DataFrame:
        rows = df.filter("lon is not null and value > 0 and qualifier = 'reported'")
        return quantiles(rows.select(F.floor(F.col("lon") / degrees).alias("cx"), F.floor(F.col("lat") / degrees).alias("cy"), "value"), ["cx", "cy"], "value", {name: 0.5})

    both = cells(obs_a, "a_median").join(cells(obs_b, "b_median"), ["cx", "cy"])
    ratio = F.col("b_median") / F.col("a_median")
    return both.withColumns({"ratio": ratio, "agree": ratio.between(0.5, 2.0), "both_above": (F.col("a_median") > threshold) & (F.col("b_median") > threshold)})


def normal_tail(z: Column) -> Column:
    """Two-sided normal p value (complementary error function, Numerical Recipes' rational fit, 1.2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.5 * x)
    # Coefficients of the fit.
    poly: Column = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    return F.least(F.lit(1.0), t * F.exp(-x * x + poly))


def paired_ratio_test(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: n, median ratio, share above 1.5, Wilcoxon signed-rank z and p (normal approximation, tie-corrected)."""
    pairs, keys, named = behind(pairs, keys)
    p = pairs.select(*keys, "ratio", F.col("log2_ratio").alias("d"))
    plus = F.count_if(F.col("d") > 0).alias("plus")
    ranked = ranked_values(p.filter("d <> 0"), keys, F.abs("d"), [plus])
    rank, t = F.col("before") + (F.col("k") + 1) / 2, F.col("k").cast("double")
    w = ranked.groupBy(*keys).agg(F.sum(F.col("plus") * rank).alias("w_plus"), F.sum(t).alias("k"), F.sum(t * t * t - t).alias("ties"))
    mean, var = F.col("k") * (F.col("k") + 1) / 4, F.col("k") * (F.col("k") + 1) * (2 * F.col("k") + 1) / 24 - F.col("ties") / 48
    w = w.withColumn("z", F.when(var > 0, (F.col("w_plus") - mean) / F.sqrt(var)))
    base = p.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(F.when(F.col("ratio") > 1.5, 1.0).otherwise(0.0)).alias("share_above"))
    base = join_on(base, quantiles(p, keys, "ratio", {"median_ratio": 0.5}), keys, "left")
    return named(join_on(base, w.select(*keys, "w_plus", "z"), keys, "left").withColumn("p_value", normal_tail(F.col("z"))))


def rank_sum_test(obs: DataFrame, column: str, group_a: str, group_b: str, keys: Sequence[str], least: int = 30) -> DataFrame:
    """Per key with ``least`` rows on each side: Mann-Whitney U of a, z, p (normal approximation, tie-corrected), b / a median ratio."""
    own = obs.filter(F.col(column).isin(group_a, group_b) & (F.col("qualifier") == "reported") & (F.col("value") > 0))
    rows, keys, named = behind(own.select(*keys, "value", (F.col(column) == group_a).alias("is_a")), keys)
    ranked = ranked_values(rows, keys, "value", [F.count_if("is_a").alias("a")])
    t = F.col("k").cast("double")
    g = ranked.groupBy(*keys).agg(
        F.sum("a").cast("double").alias("na"), F.sum(F.col("k") - F.col("a")).cast("double").alias("nb"), F.sum(F.col("a") * (F.col("before") + (F.col("k") + 1) / 2)).alias("ra"), F.sum(t * t * t - t).alias("ties")
    ).filter((F.col("na") >= least) & (F.col("nb") >= least))
    g = join_on(join_on(g, quantiles(rows.filter("is_a"), keys, "value", {"ma": 0.5}), keys), quantiles(rows.filter("not is_a"), keys, "value", {"mb": 0.5}), keys)
    n = F.col("na") + F.col("nb")
    u = F.col("ra") - F.col("na") * (F.col("na") + 1) / 2
    var = F.col("na") * F.col("nb") / 12 * (n + 1 - F.col("ties") / (n * (n - 1)))
    z = (u - F.col("na") * F.col("nb") / 2) / F.sqrt(var)
    return named(g.select(*keys, F.col("na").cast("bigint").alias("n_a"), F.col("nb").cast("bigint").alias("n_b"), u.alias("u"), z.alias("z"), normal_tail(z).alias("p_value"), (F.col("mb") / F.col("ma")).alias("median_ratio")))


def resample_positions(n: int, resamples: int, seed: int) -> np.ndarray:
    """(resamples, 2): the two middle positions of the median of n draws with replacement from n ordered values.

    The middle order statistics of n uniform draws are beta variables; a draw u stands for the value at floor(n u).
    """
    rng = np.random.default_rng(seed)
    low, high = (n - 1) // 2, n // 2
    a = rng.beta(low + 1, n - low, resamples)
    b = a if high == low else a + (1 - a) * rng.beta(1, n - high, resamples)
    return np.minimum((np.stack([a, b], axis=1) * n).astype(np.int64), n - 1)


def bootstrap_median_ci(pairs: DataFrame, keys: Sequence[str], column: str = "ratio", n: int = 2000, seed: int = 1, level: float = 0.95) -> DataFrame:
    """Per key: n, median and seeded percentile interval of the median over ``n`` resamples.

    A resample's median depends on the order of the values alone, so resamples are drawn as positions (a Python task a
    block of groups, whatever their size), and the values at these positions are selected like any quantile.
    """
    pairs, keys, named = behind(pairs.select(*keys, F.col(column).alias("ratio")), keys)
    column = "ratio"

    middle = F.array(((F.col("n") - 1) / 2).cast("bigint"), (F.col("n") / 2).cast("bigint"))

    def draw(totals: DataFrame) -> DataFrame:
        """The resamples of each group (keys, n), the same however often they are drawn."""

        def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                yield part.assign(spots=[resample_positions(int(k), n, int(s)).tolist() for k, s in zip(part["n"], part["s"])]).drop(columns="s")

        seeded = totals.withColumn("s", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(2**31 - 1)))
        return seeded.mapInPandas(each, T.StructType([*totals.schema.fields, T.StructField("spots", T.ArrayType(T.ArrayType(T.LongType())))]))

    drawn = draw(pairs.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n")))
    want = drawn.select(*keys, F.array_distinct(F.concat(F.flatten("spots"), middle)).alias("want"))
    found = join_on(values_at(pairs, keys, F.col(column), lambda rows: join_on(rows, want, keys)), drawn.select(*keys, "spots"), keys)
    by = found.groupBy(*keys).agg(F.any_value("n").alias("n"), F.any_value("spots").alias("spots"), F.map_from_entries(F.collect_list(F.struct("position", "v"))).alias("at"))
    mid = lambda p: (F.col("at")[p[0]] + F.col("at")[p[1]]) / 2
    own = by.select(*keys, "n", mid((((F.col("n") - 1) / 2).cast("bigint"), (F.col("n") / 2).cast("bigint"))).alias("median"), F.explode(F.transform("spots", lambda p: mid((p[0], p[1])))).alias("m"))
    tail = (1 - level) / 2
    return named(own.groupBy(*keys).agg(F.any_value("n").alias("n"), F.any_value("median").alias("median"), F.percentile("m", F.lit(tail)).alias("ci_low"), F.percentile("m", F.lit(1 - tail)).alias("ci_high")))


def transfer_model(pairs: DataFrame, keys: Sequence[str], split: str, train: float = 0.8) -> DataFrame:
    """Per key: log-log regression on the training share (by the MD5 of ``split`` as text), R2, ratio IQR, holdout errors.

    The holdout's median absolute percentage error is given for the power law and for the constant median ratio.
    """
    digits = F.substring(F.md5(F.col(split).cast("string")), 1, 8)
    fits = F.conv(digits, 16, 10).cast("bigint") % 100 < int(train * 100)
    p = pairs.select(*keys, "a_median", "b_median", "ratio", F.log10("a_median").alias("lx"), F.log10("b_median").alias("ly"), fits.alias("fit"))
    m = p.filter("fit").groupBy(*keys).agg(F.count("*").alias("n_train"), F.regr_slope("ly", "lx").alias("slope"), F.regr_intercept("ly", "lx").alias("intercept"), F.regr_r2("ly", "lx").alias("r2"))
    m = join_on(m, quantiles(p.filter("fit"), keys, "ratio", {"constant": 0.5}), keys)
    spread = quantiles(p, keys, "ratio", {"lo": 0.25, "hi": 0.75}).select(*keys, (F.col("hi") - F.col("lo")).alias("ratio_iqr"))
    m = join_on(m, spread, keys)
    test = join_on(p.filter("not fit"), m, keys)
    power = F.abs(F.pow(F.lit(10.0), F.col("intercept") + F.col("slope") * F.col("lx")) / F.col("b_median") - 1)
    held = test.groupBy(*keys).agg(F.count("*").alias("n_test"))
    held = join_on(held, quantiles(test, keys, power, {"mdape_power": 0.5}), keys)
    held = join_on(held, quantiles(test, keys, F.abs(F.col("a_median") * F.col("constant") / F.col("b_median") - 1), {"mdape_constant": 0.5}), keys)
    return join_on(m, held, keys, "left")


def depth_profile(obs: DataFrame, edges: Sequence[float], keys: Sequence[str], least: int = 25) -> DataFrame:
    """Per key and depth bin with ``least`` values: n, median, quartiles."""
    bin_ = F.lit(None).cast("int")
    for i, edge in enumerate(edges[:-1]):
        bin_ = F.when((F.col("depth") >= edge) & (F.col("depth") < edges[i + 1]), i).otherwise(bin_)
    rows = obs.filter("qualifier = 'reported' and value is not null").withColumn("depth_bin", bin_).filter("depth_bin is not null")
    many = rows.groupBy(*keys, "depth_bin").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return join_on(many, quantiles(rows, [*keys, "depth_bin"], "value", {"median": 0.5, "q25": 0.25, "q75": 0.75}), [*keys, "depth_bin"])


def method_fragmentation(obs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: distinct families, missing share, the top family's share, and the top 5 as text."""
    by = obs.groupBy(*keys, "method_family").agg(F.count("*").alias("n"))
    ranked = by.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "method_family")))
    known = F.col("method_family").isNotNull()
    top = F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= 5, F.struct("k", "method_family", "n")))), lambda s: F.concat_ws(":", s["method_family"], s["n"].cast("string")))
    return ranked.groupBy(*keys).agg(F.count_if(known).alias("families"), (F.sum(F.when(~known, F.col("n")).otherwise(0)) / F.sum("n")).alias("missing_share"), (F.max("n") / F.sum("n")).alias("top_share"), F.concat_ws(",", top).alias("top5"))


def threshold_exceedance(obs: DataFrame, thresholds: Mapping[str, float], keys: Sequence[str] = ("source_id",)) -> DataFrame:
    """Per key: values, their median, and how many lie above each threshold, in a column of the threshold's name."""
    v = obs.filter("qualifier = 'reported' and value is not null")
    counts = v.groupBy(*keys).agg(F.count("*").alias("n"), *[F.count_if(F.col("value") > x).alias(name) for name, x in thresholds.items()])
    return join_on(counts, quantiles(v, keys, "value", {"median": 0.5}), keys)


def enriched_bins(pairs: DataFrame, degrees: float = 2.0, least: int = 5, k: int = 8) -> DataFrame:
    """The ``k`` bins of ``degrees`` with the highest median log2 ratio among those with ``least`` pairs."""
    rows = pairs.select(F.floor(F.col("site_lon") / degrees).alias("bx"), F.floor(F.col("site_lat") / degrees).alias("by"), "log2_ratio")
    many = rows.groupBy("bx", "by").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    b = join_on(many, quantiles(rows, ["bx", "by"], "log2_ratio", {"median_log2": 0.5}), ["bx", "by"])
    return b.orderBy(F.desc("median_log2"), "bx", "by").limit(k)
