"""Readers, reshapers and writers of measurement tables."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import repeated
from .storage import DENSE, written

REQUIRED = ("element_or_analyte", "value", "unit", "medium")
RECOMMENDED = ("sample_id", "source_id", "latitude", "longitude", "analytical_method", "license")


def read_delimited(spark: SparkSession, path: str, schema_map: Mapping[str, str] | None = None, sep: str = ",", required: Sequence[str] = REQUIRED) -> tuple[DataFrame, list[str]]:
    """(table of text columns, missing recommended columns). Headers are trimmed and mapped ``{canonical: source}``.

    Two headers alike, or a required column missing, raise ValueError. The header is read on its own, one line; the
    rows are read by Spark under the names found there.
    """
    first = spark.read.option("header", False).option("sep", sep).csv(path).limit(1).collect()
    names = [(v or "").lstrip("﻿").strip() for v in (first[0] if first else ())]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"headers repeat: {names}")
    schema = ", ".join(f"`{n}` string" for n in names)
    df = spark.read.option("header", True).option("enforceSchema", True).option("sep", sep).schema(schema).csv(path)
    df = df.withColumnsRenamed({source: canonical for canonical, source in (schema_map or {}).items()})
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df, [c for c in RECOMMENDED if c not in df.columns]


def read_units_header_table(spark: SparkSession, path: str, header_marker: str) -> tuple[DataFrame, dict[str, str]]:
    """(rows, {column: unit}) of a tab-separated table: preamble, a header line that starts with the marker, units, rows.

    Only the header and the line after it, found by their place in the file, come to the driver. In a folder of many
    files one has the header; the others, in any order, have rows only.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"))
    head = lines.filter(F.col("value").startswith(header_marker)).orderBy("n").first()
    if head is None:
        raise ValueError("no header line")
    own = F.col("file") == head.file
    units = lines.filter(own & (F.col("n") > head.n)).orderBy("n").first()
    names = [c.strip() for c in head.value.split("\t")]
    unit = [c.strip() for c in units.value.split("\t")] if units else []
    cells = F.split("value", "\t", -1)
    rows = lines.filter((~own | (F.col("n") > (units.n if units else head.n))) & (F.trim("value") != ""))
    return rows.select(*[F.trim(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(names)]), dict(zip(names, unit))


def melt_wide(df: DataFrame, id_cols: Sequence[str], columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """id columns, analyte, value, unit: a row per filled cell of the (column, analyte, unit) given."""
    cells = F.array(*[F.struct(F.lit(a).alias("analyte"), F.col(c).cast("string").alias("value"), F.lit(u).alias("unit")) for c, a, u in columns])
    return df.select(*id_cols, F.inline(cells)).filter(F.trim("value") != "")


def melt_long(df: DataFrame, id_cols: Sequence[str], analyte: str, value: str, unit: str | None = None, unit_constant: str | None = None) -> DataFrame:
    """id columns, analyte, value, unit of a table that is long already; a missing unit is the constant."""
    u = F.coalesce(F.nullif(F.trim(F.col(unit)), F.lit("")) if unit else F.lit(None).cast("string"), F.lit(unit_constant))
    return df.select(*id_cols, F.col(analyte).alias("analyte"), F.col(value).cast("string").alias("value"), u.alias("unit")).filter(F.trim("value") != "")


def apply_row_filters(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Keep the rows that every rule holds for: {column, op: not_null | equals | in, value}; compared as text."""
    for rule in rules:
        text = F.trim(F.col(rule["column"]).cast("string"))
        if rule["op"] == "not_null":
            df = df.filter(text != "")
        elif rule["op"] == "equals":
            df = df.filter(text == str(rule["value"]))
        elif rule["op"] == "in":
            df = df.filter(text.isin(*map(str, rule["value"])))
        else:
            raise ValueError(f"unknown rule: {rule['op']}")
    return df


def melt_value_quality(df: DataFrame, id_cols: Sequence[str], columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """id columns, analyte, value, quality: (value column, flag column, analyte) triples unpivoted together."""
    cells = F.array(*[F.struct(F.lit(a).alias("analyte"), F.col(v).cast("double").alias("value"), F.col(q).cast("string").alias("quality")) for v, q, a in columns])
    return df.select(*id_cols, F.inline(cells)).filter("value is not null")


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Union over the superset of columns, first seen first; what a table lacks is null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def union_sources(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(merged table, problems). ``source_file`` gets its source in front; problems are null or repeated record ids and
    foreign source ids, as (record_id, problem) rows."""
    parts = [t.withColumn("source_file", F.concat_ws("/", F.lit(s), "source_file")).withColumn("_from", F.lit(s)) for s, t in tables.items()]
    merged = union_by_name(parts)
    repeated = merged.filter("record_id is not null").groupBy("record_id").agg(F.count("*").alias("n")).filter("n > 1").select("record_id", F.lit("repeated_id").alias("problem"))
    null = merged.filter("record_id is null").select("record_id", F.lit("null_id"))
    foreign = merged.filter(~F.col("source_id").eqNullSafe(F.col("_from"))).select("record_id", F.lit("foreign_source"))
    return merged.drop("_from"), repeated.union(null).union(foreign)


EVIDENCE = "record_id string, source_id string, source_locator string, license string, analyte_reported string, source_record_id string, dataset_title string, dataset_doi string, dataset_version string, source_file string, source_row string, source_file_sha256 string"


def read_record_evidence(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of record evidence under a fixed schema."""
    return spark.read.schema(EVIDENCE).json(path)


def _text(df: DataFrame) -> list[Column]:
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f.name)
        out.append((F.to_json(c) if kind in ("array", "struct", "map") else c.cast("string")).alias(f.name))
    return out


def write_canonical(obs: DataFrame, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None) -> None:
    """Write in a fixed column order; as CSV, booleans, arrays and structs become text."""
    obs = obs.select(*(columns or obs.columns))
    if fmt == "csv":
        obs.select(*_text(obs)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        obs.write.mode("overwrite").format(fmt).save(path)


def to_geojson_features(df: DataFrame, lon: str, lat: str, props: Sequence[str]) -> DataFrame:
    """One ``feature`` text a row; without coordinates the geometry is null."""
    point = F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))
    whole = F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*props).alias("properties")), {"ignoreNullFields": "false"})
    return df.select(whole.alias("feature"))


#: Bytes a task holds of a file that it reads in blocks.
BLOCK = 8 << 20


def _hashed_in_blocks(files: DataFrame) -> DataFrame:
    """path, bytes, sha256 of files (path, length), each read by one task a block at a time. Nested, so that executors
    need no copy of this package."""

    def digests(batches):
        for batch in batches:
            found = []
            for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                system, inner = fs.FileSystem.from_uri(quote(path, safe="/:@"))
                digest, seen = hashlib.sha256(), 0
                with system.open_input_stream(inner) as stream:
                    while block := stream.read(BLOCK):
                        digest.update(block)
                        seen += len(block)
                if seen != size:
                    raise OSError(f"{path} has {seen} bytes, not the {size} it was listed with")
                found.append({"path": path, "bytes": size, "sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(found, pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    return files.mapInArrow(digests, "path string, bytes long, sha256 string")


def file_manifest(spark: SparkSession, glob: str, in_blocks_from: int = 64 << 20) -> DataFrame:
    """path (the file's name), bytes, sha256 of every file that the glob names, empty ones too.

    Small files are cells of Spark's own reader. Those of ``in_blocks_from`` bytes and more, of any size, are listed by
    Spark without their content and read by a task each in blocks of 8 MB, from file systems that Arrow knows. Scans
    leave out empty files; these are what the driver's list of the glob, which Spark holds anyway, has beyond the scan.
    """
    files = spark.read.format("binaryFile").load(glob)
    small = files.filter(F.col("length") < in_blocks_from).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = _hashed_in_blocks(files.filter(F.col("length") >= in_blocks_from).select("path", "length"))
    listed = spark.createDataFrame([(unquote(f),) for f in files.inputFiles()], "path string")
    plain = F.regexp_replace("path", "^file:/+", "file:/").alias("path")
    empty = listed.select(plain).join(files.select(plain), "path", "left_anti").select("path", F.lit(0).cast("bigint"), F.sha2(F.lit("").cast("binary"), 256))
    return small.union(large).union(empty).withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change) of added, removed and changed members."""
    both = before.select("path", F.col("sha256").alias("a")).join(after.select("path", F.col("sha256").alias("b")), "path", "full")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", change.alias("change")).filter("change is not null")


# ------------------------------------------------------------------- archive

BUNDLE = (
    "dataset struct<dataset_id: string, title: string, license: string>, files array<struct<file_id: string, sha256: string>>, events array<struct<event_id: string, place: string>>, "
    "samples array<struct<sample_id: string, event_id: string, medium: string, lithology: string, description: string>>, "
    "methods array<struct<method_id: string, family: string, technique: string, laboratory: string, publication_ids: array<string>>>, "
    "observations array<struct<observation_id: string, sample_id: string, method_id: string, element: string, value: double, provenance_id: string>>, "
    "publications array<struct<publication_id: string, doi: string, citation: string, title: string, year: int, dataset_ids: array<string>, relation_types: array<string>>>, "
    "acquisition_runs array<struct<acquisition_run_id: string, status: string, started_at: string, finished_at: string, dataset_ids: array<string>>>, "
    "lineage array<struct<provenance_id: string, acquisition_run_id: string, source_record_id: string, source_row: bigint, input_sha256: string>>, "
    "part_of string"
)
#: What describes a dataset rather than its measurements.
ABOUT = ("files", "events", "methods", "publications", "acquisition_runs")


#: A bundle with more parts than this does not look its observations' parts up in itself.
FEW = 8
#: As many ids as may be broadcast of those that are not all in one bundle.
STRAYS = 100_000


class Archive(dict):
    """The tables of bundles by name, and the parsed bundles: what belongs together mostly lies in one bundle and can meet there,
    without a shuffle. A table that was replaced is met by its keys alone."""

    def __init__(self, bundles: DataFrame, tables: Mapping[str, DataFrame]) -> None:
        super().__init__(tables)
        self.bundles, self._made = bundles, dict(tables)

    def holds(self, *names: str) -> bool:
        return all(self[n] is self._made[n] for n in names)


def explode_archive_bundle(bundles: DataFrame, column: str = "bundle") -> Archive:
    """The tables of nested JSON bundles, each with its dataset_id: datasets, files, events, samples, methods, observations,
    lineage (the lines of a source and the run that fetched them), provenance (an observation's dataset and line).

    publications, acquisition_runs and the links method_publications, publication_datasets (each dataset of a publication
    with each of its relations) and run_datasets stand for themselves. A large dataset comes as many bundles: one has the
    dataset, the others name its id in ``part_of``.

    Bundles are parsed once and written to the shared folder, where each table reads its own columns; what describes whole
    datasets is written apart, so that Spark knows how small it is when measurements meet it.
    """
    parsed = bundles.select(F.from_json(column, BUNDLE).alias("b")).select("b.*").withColumn("dataset_id", F.coalesce("part_of", "dataset.dataset_id"))
    parsed = written(parsed, **DENSE)
    heads = written(parsed.filter(F.col("part_of").isNull() | F.greatest(*[F.col(c).isNotNull() for c in ABOUT])).select("part_of", "dataset_id", "dataset", *ABOUT))
    out = {"datasets": heads.filter("part_of is null").select("dataset.*")}
    for name in ("files", "events", "samples", "methods", "observations", "lineage"):
        out[name] = (heads if name in ABOUT else parsed).select("dataset_id", F.inline(name))
    link = lambda df, key, many, one: df.select(key, F.explode(many).alias(one))
    papers, runs = heads.select(F.inline("publications")), heads.select(F.inline("acquisition_runs"))
    out["publications"], out["acquisition_runs"] = papers.drop("dataset_ids", "relation_types"), runs.drop("dataset_ids")
    out["publication_datasets"] = papers.select("publication_id", "relation_types", F.explode("dataset_ids").alias("dataset_id")).select("publication_id", "dataset_id", F.explode("relation_types").alias("relation_type"))
    out["method_publications"] = link(out["methods"], "method_id", "publication_ids", "publication_id")
    out["run_datasets"] = link(runs, "acquisition_run_id", "dataset_ids", "dataset_id")
    out["methods"] = out["methods"].drop("publication_ids")
    out["provenance"] = out["observations"].select("observation_id", "dataset_id", "provenance_id")
    return Archive(parsed, out)


def _strays(tables: Mapping[str, DataFrame], part: str, key: str) -> DataFrame | None:
    """The hashes of the ids ``key`` that are not all in one bundle, or name several of ``part`` (samples, lineage), or lie in a
    bundle with many; written. None if there are too many to be broadcast, or no bundles to look into: then rows have to
    meet by keys. Only hashes are shuffled; ids that share one are taken for one id in two bundles."""
    if not isinstance(tables, Archive) or not tables.holds(part, "observations"):
        return None
    none = F.array().cast("array<string>")
    own, used = F.coalesce(f"{part}.{key}", none), F.coalesce(f"observations.{key}", none)
    ids = tables.bundles.select(F.when(F.size(own) > FEW, 2).otherwise(1).alias("n"), F.explode(F.concat(own, F.array_except(used, own))).alias("id"))
    found = written(ids.groupBy(F.xxhash64("id").alias("h")).agg(F.sum("n").alias("n")).filter("n > 1").select("h"))
    return found if found.count() <= STRAYS else None


def _of(df: DataFrame, strays: DataFrame, key: str, how: str) -> DataFrame:
    """The rows whose ``key`` is a stray id (left_semi), or is none (left_anti); null is a key."""
    return df.join(F.broadcast(strays), F.xxhash64(df[key]) == strays["h"], how)


def _in_bundles(tables: Archive, part: str, key: str, fields: Sequence[str], strays: DataFrame, outer: bool) -> DataFrame:
    """dataset_id, ``fields`` and ``key`` (as _key) of each observation and the columns of the ``part`` of its bundle that has it."""
    rows = tables.bundles.filter(F.coalesce(F.size(part) <= FEW, F.lit(True))).select("dataset_id", F.col(part).alias("_parts"), F.inline("observations")).select("dataset_id", *fields, F.col(key).alias("_key"), "_parts")
    met = F.filter("_parts", lambda p: p[key] == F.col("_key"))
    return _of(rows, strays, "_key", "left_anti").select("dataset_id", *fields, "_key", (F.inline_outer if outer else F.inline)(met))


def _sampled(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Observations with their samples."""
    observations, samples = tables["observations"], tables["samples"].drop("dataset_id")
    by_key = lambda o, s: o.join(s, "sample_id")
    strays = _strays(tables, "samples", "sample_id")
    if strays is None:
        return by_key(observations, samples)
    fields = [c for c in observations.columns if c not in ("dataset_id", "sample_id")]
    here = _in_bundles(tables, "samples", "sample_id", fields, strays, outer=False).drop("_key")
    return here if strays.isEmpty() else here.unionByName(by_key(_of(observations, strays, "sample_id", "left_semi"), _of(samples, strays, "sample_id", "left_semi")))


def _summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """sample_id, medium, observations, elements: one row for each, samples without observations too."""

    def by_key(samples, observations):
        # Counted before they meet: a sample's row is joined with one row, and repeated samples count as often as before.
        many = samples.groupBy("sample_id", "medium").agg(F.count("*").alias("_m"))
        each = observations.groupBy("sample_id").agg(F.count("observation_id").alias("_n"), F.collect_set("element").alias("_e"))
        return many.join(each, "sample_id", "left").select("sample_id", "medium", (F.col("_m") * F.coalesce("_n", F.lit(0))).alias("observations"), F.array_sort(F.coalesce("_e", F.array().cast("array<string>"))).alias("elements"))

    strays = _strays(tables, "samples", "sample_id")
    if strays is None:
        return by_key(tables["samples"], tables["observations"])
    rows = tables.bundles.filter(F.size("samples") <= FEW).select("observations", F.inline("samples")).select("sample_id", "medium", "observations")
    own = F.filter(F.coalesce("observations", F.array()), lambda o: o["sample_id"] == F.col("sample_id"))
    rows = _of(rows, strays, "sample_id", "left_anti").select("sample_id", "medium", own.alias("own"))
    here = rows.select("sample_id", "medium", F.size(F.array_compact("own.observation_id")).cast("bigint").alias("observations"), F.array_sort(F.array_distinct(F.array_compact("own.element"))).alias("elements"))
    return here if strays.isEmpty() else here.union(by_key(_of(tables["samples"], strays, "sample_id", "left_semi"), _of(tables["observations"], strays, "sample_id", "left_semi")))


def _traced(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Observations' datasets with their lines, null where there is none, and the state of the run that fetched them."""
    provenance, lines = tables["provenance"], tables["lineage"].drop("dataset_id")
    by_key = lambda p, s: p.join(s, "provenance_id", "left")
    strays = _strays(tables, "lineage", "provenance_id") if not isinstance(tables, Archive) or tables.holds("provenance") else None
    if strays is None:
        met = by_key(provenance, lines)
    else:
        rest = [c for c in lines.columns if c != "provenance_id"]
        met = _in_bundles(tables, "lineage", "provenance_id", ["observation_id"], strays, outer=True)
        met = met.select(F.col("_key").alias("provenance_id"), "observation_id", "dataset_id", *rest)
        if not strays.isEmpty():
            met = met.unionByName(by_key(_of(provenance, strays, "provenance_id", "left_semi"), _of(lines, strays, "provenance_id", "left_semi")))
    return met.join(tables["acquisition_runs"].select("acquisition_run_id", "status"), "acquisition_run_id", "left")


VIEWS = ("observation_search", "sample_summary", "source_coverage", "provenance_trace")


def archive_views(tables: Mapping[str, DataFrame], names: Sequence[str] = VIEWS) -> dict[str, DataFrame]:
    """observation_search (the 5-way join), sample_summary, source_coverage, provenance_trace; those of ``names``.

    An observation meets its sample and its line in the bundle that holds them. Only where ids are spread over bundles are rows
    shuffled: hashes of the ids, counted when the view is built, tell which.
    """
    t, out = tables, {}
    if {"observation_search", "source_coverage"} & set(names):
        search = _sampled(t).join(t["events"].drop("dataset_id"), "event_id").join(t["methods"].drop("dataset_id"), "method_id").join(t["datasets"], "dataset_id")
        coverage = search.groupBy("dataset_id", "title").agg(F.count("*").alias("observations"), F.count_distinct("sample_id").alias("samples"), F.count_distinct("element").alias("elements"))
        out |= {"observation_search": search, "source_coverage": coverage}
    if "sample_summary" in names:
        out["sample_summary"] = _summary(t)
    if "provenance_trace" in names:
        trace = _traced(t) if "lineage" in t else t["provenance"]
        out["provenance_trace"] = trace.join(t["datasets"], "dataset_id").join(t["files"].groupBy("dataset_id").agg(F.count("*").alias("files")), "dataset_id", "left")
    return out


def export_flat(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The archive as a measurement table; a missing value gets the reason not_reported."""
    s = archive_views(tables, ["observation_search"])["observation_search"]
    return s.select(F.col("observation_id").alias("record_id"), "sample_id", F.col("element").alias("element_or_analyte"), F.col("value").cast("string").alias("value"), "medium", F.col("family").alias("method_family"), F.col("dataset_id").alias("source_id"), "title", "license", F.when(F.col("value").isNull(), "not_reported").alias("missing_reason"))


KEYS = {"datasets": "dataset_id", "files": "file_id", "events": "event_id", "samples": "sample_id", "methods": "method_id", "observations": "observation_id", "publications": "publication_id", "acquisition_runs": "acquisition_run_id", "lineage": "provenance_id"}
LINKS = (("samples", "event_id", "events"), ("observations", "sample_id", "samples"), ("observations", "method_id", "methods"), ("files", "dataset_id", "datasets"), ("provenance", "observation_id", "observations"),
         ("method_publications", "publication_id", "publications"), ("publication_datasets", "publication_id", "publications"), ("publication_datasets", "dataset_id", "datasets"), ("run_datasets", "dataset_id", "datasets"), ("lineage", "acquisition_run_id", "acquisition_runs"))


#: Tables as long as the measurements: their keys are counted by hashes of eight bytes.
LONG = ("samples", "observations", "lineage")


def _repeated_keys(df: DataFrame, key: str, long: bool) -> DataFrame:
    """(key, n) of the keys that more than one row has, null among them. Of a long table only hashes are shuffled, and the
    keys of rows that share one."""
    keys = df.select(F.col(key).alias("key"))
    if long:
        hashed = keys.withColumn("h", F.xxhash64("key"))
        keys = hashed.join(repeated(hashed, "h"), "h", "left_semi")
    return keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")


def _dangling(tables: Mapping[str, DataFrame], name: str, key: str, other: str) -> DataFrame:
    """(key, n) of the keys in ``name`` that ``other`` lacks. Rows whose bundle holds what they name are not asked for again."""
    known = tables[other].select(F.col(key).alias("key"))
    rows = tables[name].select(F.col(key).alias("key"))
    found = isinstance(tables, Archive) and tables.holds(name, other) and (name, other) in (("observations", "samples"), ("provenance", "observations"))
    if not found:
        return rows.join(known.distinct(), "key", "left_anti").groupBy("key").agg(F.count("*").alias("n"))
    if name == "provenance":  # made of the observations themselves
        rows = rows.filter("key is null")
    else:
        own = tables.bundles.select(F.when(F.size(other) <= FEW, F.col(f"{other}.{key}")).alias("own"), F.explode(f"{name}.{key}").alias("key"))
        rows = own.filter(~F.coalesce(F.array_contains("own", F.col("key")), F.lit(False)))
    few = written(rows.groupBy("key").agg(F.count("*").alias("n")))
    return few.join(known.join(few.select("key"), "key", "left_semi").distinct(), "key", "left_anti")


def archive_integrity(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, key, problem, n): repeated primary keys and dangling foreign keys."""
    parts = [_repeated_keys(tables[name], key, name in LONG).select(F.lit(name).alias("table"), "key", F.lit("repeated_key").alias("problem"), "n") for name, key in KEYS.items()]
    parts += [_dangling(tables, name, key, other).select(F.lit(name), "key", F.lit(f"no_{other}"), "n") for name, key, other in LINKS]
    return reduce(DataFrame.union, parts)


def distinct_words(query: str) -> list[str]:
    """The different words of a query, lower-cased, in order."""
    return sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})


def words_of(text: Column) -> Column:
    """The different words of a text, lower-cased; ends of the text may add an empty one."""
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"))


def has_tokens(text: Column, query: str) -> Column:
    """Whether a text holds every word of ``query``, whatever the case; a query without words matches nothing."""
    wanted = distinct_words(query)
    if not wanted:
        return F.lit(False)
    tokens = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), tokens)) == 0


def query_observations(view: DataFrame, *, filters: Mapping[str, Sequence[str]] | None = None, any_of: Mapping[str, Sequence[str]] | None = None, box: Sequence[float] | None = None, time_from: str | None = None, time_to: str | None = None, text: str | None = None, text_columns: Sequence[str] = (), ids: DataFrame | None = None, columns: Sequence[str] = ("record_id",), limit: int = 1000) -> DataFrame:
    """Distinct, ordered rows, at most ``limit`` (1 to 10,000): IN filters by column, columns of which one must match
    (geology), a box, a text time range, words found in the text columns together, ids."""
    from ..functions.standardize import inside_box

    if not 1 <= limit <= 10_000:
        raise ValueError("limit must be 1 to 10000")
    for column, values in (filters or {}).items():
        view = view.filter(F.col(column).isin(*values))
    if any_of:
        view = view.filter(reduce(lambda a, b: a | b, [F.coalesce(F.col(c).isin(*v), F.lit(False)) for c, v in any_of.items()]))
    if box:
        view = view.filter(inside_box(F.col("lon"), F.col("lat"), box))
    if time_from:
        view = view.filter(F.col("sampled_at") >= time_from)
    if time_to:
        view = view.filter(F.col("sampled_at") <= time_to)
    if text is not None:
        view = view.filter(has_tokens(F.concat_ws(" ", *text_columns), text))
    if ids is not None:
        view = view.join(ids, ids.columns[0], "left_semi")
    return view.select(*columns).distinct().orderBy(*columns).limit(limit)


def text_search(entities: DataFrame, query: str, key: str = "entity_id", text: str = "text") -> DataFrame:
    """(key) of the entities, a row each, whose text has every word of the query: one predicate a row, no shuffle."""
    return entities.filter(has_tokens(F.col(text), query)).select(key)


def declared_coverage_subset(obs: DataFrame, source_countries: DataFrame, region: Sequence[str]) -> DataFrame:
    """Rows with coordinates, and those without whose source declares only countries of the region."""
    inside = source_countries.filter((F.size("countries") > 0) & (F.size(F.array_except("countries", F.array(*[F.lit(c) for c in region]))) == 0)).select("source_id")
    return obs.filter("lon is not null").unionByName(obs.filter("lon is null").join(inside, "source_id", "left_semi").select(*obs.columns))


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, with the side."""
    left, right = a.select(*keys), b.select(*keys)
    return left.subtract(right).withColumn("side", F.lit("a")).union(right.subtract(left).withColumn("side", F.lit("b")))


def key_intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


