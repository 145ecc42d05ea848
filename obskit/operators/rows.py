"""Row-wise operators on the measurement table: ids, layers, labels, issues and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import fresh, scratch
from ..functions.standardize import blank_to_null, flags, inside_box, stable_id
from ..sources.storage import written


@scratch("_sid", "_doi", "_fields", "_crs")
def coordinate_policy_join(df: DataFrame, policies: DataFrame) -> DataFrame:
    """Fill a missing source_crs where source, DOI pattern and both coordinate fields match a policy."""
    p = policies.select(F.col("source_id").alias("_sid"), F.col("doi_pattern").alias("_doi"), F.col("fields").alias("_fields"), F.col("crs").alias("_crs"))
    match = (F.col("source_id") == F.col("_sid")) & F.expr("doi rlike _doi") & F.array_contains("_fields", F.col("lat_field")) & F.array_contains("_fields", F.col("lon_field"))
    given = blank_to_null(F.col("source_crs"))
    out = df.join(p, match, "left")
    return out.withColumns({"policy_applied": given.isNull() & F.col("_crs").isNotNull(), "source_crs": F.coalesce(given, "_crs")}).drop("_sid", "_doi", "_fields", "_crs")


def repeated(df: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` that more than one row has, written: Spark then knows how few they are."""
    return written(df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key))


def with_stable_ids(df: DataFrame, keys: Sequence[str], order: str, place: str | None = None) -> DataFrame:
    """Add stable_id over the keys, and the occurrence number of each repeat.

    ``place`` may name a column that numbers the rows of a stored table. Then only rows whose keys have the hash of another
    row's are shuffled and sorted; all others are the first of their kind."""
    again = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    ids = stable_id("gen-", *[F.col(k) for k in keys])
    if place is None:
        return df.withColumns({"stable_id": ids, "occurrence": again})
    short, turn = fresh([*df.columns, "stable_id", "occurrence"], "short", "turn")
    keyed = df.withColumn(short, F.xxhash64(*keys))
    numbers = written(keyed.join(repeated(keyed, short), short, "left_semi").select(place, again.alias(turn)))
    out = df.join(numbers, place, "left").select(*[F.col(f"`{c}`") for c in df.columns], turn)
    return out.withColumns({"stable_id": ids, "occurrence": F.coalesce(turn, F.lit(1))}).drop(turn)


#: What strict provenance needs beside an https address.
PROVENANCE = ("source_id", "title", "version", "license", "doi")


def evidence_layer(obs: DataFrame, errors: Sequence[str], provenance: Sequence[str] = PROVENANCE) -> DataFrame:
    """Add missing_provenance, gaps, qc_status and layer: strict has no gap and clear flags, traceable names its source
    and an address, incomplete doesn't. Marine rows need no geological context. Reads qc_flags."""
    missing = flags(*[(c, blank_to_null(F.col(c)).isNull()) for c in provenance], ("url", ~F.coalesce(F.col("url").rlike("^https?://[^/ ]+"), F.lit(False))))
    out = obs.withColumn("missing_provenance", missing)
    gaps = flags(
        ("strict_provenance", F.size("missing_provenance") > 0), ("coordinate", F.col("lon").isNull() | F.col("lat").isNull()), ("method", F.col("method_family").isNull() & F.col("basis").isNull()),
        ("geology", F.col("lithology").isNull() & ~F.col("domain").eqNullSafe("marine")), ("quantity", F.col("value").isNull() | F.col("unit").isNull()),
    )
    status = F.when(F.col("qc_flags").isNull(), "not_evaluated").when(F.exists("qc_flags", lambda f: f.isin(*errors)), "blocked").otherwise("clear")
    out = out.withColumns({"gaps": gaps, "qc_status": status})
    traced = F.col("source_id").isNotNull() & F.col("url").isNotNull()
    strict = (F.size("gaps") == 0) & (F.col("qc_status") == "clear")
    return out.withColumn("layer", F.when(strict, "strict").when(traced, "traceable").otherwise("incomplete"))


def geologic_display(labels: Mapping[str, Column]) -> Column:
    """struct<label, basis>: the first label there is, with the name of where it comes from."""
    basis = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in labels.items()])
    return F.struct(F.coalesce(*labels.values()).alias("label"), basis.alias("basis"))


def resolve_value(value: Column, unit: Column, qualifier: Column, limit: Column, original: Column, original_unit: Column) -> Column:
    """struct<value, unit, censored, limit>, the original value and unit standing in for missing ones."""
    censored = qualifier.isin("lt", "le", "gt", "ge", "bdl", "loq", "nd", "trace")
    use = F.when(~censored, F.coalesce(value, original))
    return F.struct(use.alias("value"), F.coalesce(unit, original_unit).alias("unit"), censored.alias("censored"), F.when(censored, limit).alias("limit"))


def semantic_enrichment(df: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add controlled_type by (source_id, sample_type) from a small contract table; codes without one are ``unmapped``."""
    out = df.join(contracts, ["source_id", "sample_type"], "left")
    return out.withColumn("unmapped", F.col("controlled_type").isNull())


#: (code, owner, severity, status, rule) of the row checks.
ISSUES = (
    ("SOURCE_LOCATOR_MISSING", "source", "error", "open", "url is null"),
    ("LICENSE_MISSING", "source", "warning", "open", "license is null"),
    ("COORDINATE_UNUSABLE", "source", "error", "open", "lon is null or lat is null"),
    ("SAMPLE_TYPE_MISSING", "source", "warning", "open", "sample_type is null"),
    ("ANALYTICAL_METHOD_MISSING", "source", "warning", "open", "method_family is null or basis is null"),
    ("METHOD_SCOPE_MISSING", "workflow", "info", "open", "method_scope is null"),
    ("GEOLOGIC_CONTEXT_MISSING", "workflow", "warning", "open", "lithology is null and domain = 'land'"),
    ("CENSORED_OBSERVATION", "workflow", "info", "accepted", "qualifier <> 'reported'"),
    ("NORMALIZATION_FAILED", "workflow", "error", "open", "value is null and qualifier = 'reported'"),
    ("NORMALIZED_UNIT_MISSING", "workflow", "error", "open", "value is not null and unit is null"),
    ("LOW_OPERATIONAL_CONFIDENCE", "workflow", "info", "open", "band = 'low'"),
    ("REFERENCE_SYSTEM_MISSING", "source", "warning", "open", "lon is not null and crs is null"),
)


def row_issues(obs: DataFrame, rules=ISSUES) -> DataFrame:
    """One row for each rule that a record breaks (record_id, source_id, code, owner, severity, status, item_id); the
    item id is the same in every run."""
    made = F.array_compact(F.array(*[F.when(F.expr(r), F.struct(F.lit(c).alias("code"), F.lit(o).alias("owner"), F.lit(s).alias("severity"), F.lit(w).alias("status"))) for c, o, s, w, r in rules]))
    out = obs.select("record_id", "source_id", F.inline(made))
    return out.withColumn("item_id", stable_id("issue-", F.col("code"), F.col("record_id")))


def profile_filter(obs: DataFrame, profile: Mapping[str, str]) -> DataFrame:
    for column, value in profile.items():
        obs = obs.filter(F.col(column) == value)
    return obs


#: Generic words that a basis may contain as one of its parts.
GENERIC = ("total", "dissolved", "extractable", "high", "urgent", "low", "medium")


def basis_matches(basis: Column, wanted: Sequence[str]) -> Column:
    """A basis equals a wanted one when both are slugs, or has a wanted generic word as a part."""
    slug = F.regexp_replace(F.lower(basis), "[^a-z0-9]+", "_")
    out = F.lit(False)
    for w in wanted:
        w = "_".join(x for x in "".join(c if c.isalnum() else " " for c in w.lower()).split())
        out = out | (slug == w)
        if w in GENERIC:
            out = out | F.concat(F.lit("_"), slug, F.lit("_")).contains(f"_{w}_")
    return F.coalesce(out, F.lit(False))


def geology_label_filter(obs: DataFrame, labels: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows with a requested label among the reported and matched ones, whatever the case."""
    own = F.array_compact(F.array(*[F.lower(F.trim(F.col(c))) for c in columns]))
    return obs.filter(F.arrays_overlap(own, F.array(*[F.lit(x.lower()) for x in labels])))


def request_filter(obs: DataFrame, request: Mapping) -> tuple[DataFrame, DataFrame]:
    """(kept rows, (outcome, n)): predicates in order, each dropped row counted under the first that fails."""
    year = F.substring("sampled_at", 1, 4).try_cast("int")
    no = lambda c: ~F.coalesce(c, F.lit(False))
    rules = [
        ("element", "elements", lambda v: F.col("element").isin(*v)), ("medium", "media", lambda v: F.col("medium").isin(*v)), ("source", "sources", lambda v: F.col("source_id").isin(*v)),
        ("source", "without_sources", lambda v: ~F.col("source_id").isin(*v)), ("basis", "bases", lambda v: basis_matches(F.col("basis"), v)),
        ("region", "box", lambda v: inside_box(F.col("lon"), F.col("lat"), v)), ("time", "years", lambda v: year.between(*v)),
        ("geology", "lithologies", lambda v: F.col("lithology").isin(*v)),
    ]
    reason = F.lit(None).cast("string")
    for name, key, test in reversed(rules):
        if key in request:
            reason = F.when(no(test(request[key])), name).otherwise(reason)
    (why,) = fresh(obs, "reason")
    judged = obs.withColumn(why, reason)
    counts = judged.groupBy(F.coalesce(why, F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))
    return judged.filter(F.col(why).isNull()).drop(why), counts
