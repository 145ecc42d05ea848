"""Queries of readers, reshapers, the archive and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import layout as L
from ..sources import search as I
from ..sources import tables as T
from ..sources.storage import new_folder
from .base import query


def scratch(t) -> str:
    """A new folder in the shared place for files that a reader reads back."""
    return new_folder(t.spark)


@query("s1_read_delimited", "select record_id, element as element_or_analyte, cast(source_row as varchar) as value, unit, medium from obs")
def s1(t):
    path = scratch(t)
    rows = t.obs.select("record_id", F.col("element").alias(" Analyte "), F.col("source_row").cast("string").alias("amount"), "unit", "medium")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    df, _ = T.read_delimited(t.spark, path, {"element_or_analyte": "Analyte", "value": "amount"})
    return df


@query("s2_read_units_header_table", """select sample_id as "Station", cast(depth as varchar) as "Depth", cast(source_row as varchar) as "As", 'ug/L' as unit from obs where value is not null""")
def s2(t):
    path = scratch(t)
    lines = t.spark.createDataFrame([("# made",), ("Station\tDepth\tAs",), ("\tm\tug/L",)], "value string").coalesce(1)
    body = t.obs.filter("value is not null").select(F.concat_ws("\t", "sample_id", F.col("depth").cast("string"), F.col("source_row").cast("string")).alias("value"))
    lines.write.text(path)
    body.write.mode("append").text(path)
    df, units = T.read_units_header_table(t.spark, path, "Station\t")
    return df.withColumn("unit", F.lit(units["As"]))


@query("s3_melt_wide", "select sample_id, 'As' as analyte, cast(source_row as varchar) as value, 'mg/kg' as unit from obs union all select sample_id, 'Pb', lithology, 'ppm' from obs where lithology is not null")
def s3(t):
    return T.melt_wide(t.obs, ["sample_id"], [("source_row", "As", "mg/kg"), ("lithology", "Pb", "ppm")])


@query("s4_melt_long", "select sample_id, element as analyte, cast(source_row as varchar) as value, coalesce(license, 'none') as unit from obs")
def s4(t):
    return T.melt_long(t.obs, ["sample_id"], "element", "source_row", "license", "none")


@query("s5_apply_row_filters", "select record_id from obs where license is not null and medium = 'soil' and source_row % 3 in (0, 1)")
def s5(t):
    df = t.obs.withColumn("third", F.col("source_row") % 3)
    return T.apply_row_filters(df, [{"column": "license", "op": "not_null"}, {"column": "medium", "op": "equals", "value": "soil"}, {"column": "third", "op": "in", "value": [0, 1]}]).select("record_id")


@query("s6_melt_value_quality", "select sample_id, 'x' as analyte, value, qualifier as quality from obs where value is not null union all select sample_id, 'limit', censor_limit, medium from obs where censor_limit is not null")
def s6(t):
    return T.melt_value_quality(t.obs, ["sample_id"], [("value", "qualifier", "x"), ("censor_limit", "medium", "limit")])


def _parts(t):
    """Six tables, one a source with columns of their own; every 50th row of src-2 is among those of src-1."""
    o = t.obs.withColumn("source_file", F.lit("f.csv"))
    stray = (F.col("source_id") == "src-2") & (F.col("source_row") % 50 == 0)
    parts = {f"src-{k}": o.filter(((F.col("source_id") == f"src-{k}") & ~stray) | (stray if k == 1 else F.lit(False))) for k in range(6)}
    return {k: p.drop("lithology" if k == "src-0" else "basis") for k, p in parts.items()}


@query("s7_union_sources", "select record_id, 'repeated_id' as problem from obs group by 1 having count(*) > 1 union all select record_id, 'foreign_source' from obs where source_id = 'src-2' and source_row % 50 = 0")
def s7(t):
    return T.union_sources(_parts(t))[1]


@query("u1_union_by_name", "select record_id, case when source_id <> 'src-0' then lithology end as lithology, case when source_id = 'src-0' then basis end as basis from obs")
def u1(t):
    return T.union_by_name(list(_parts(t).values())).select("record_id", "lithology", "basis")


@query("u2_key_difference", "(select record_id, 'a' as side from obs except select record_id, 'a' from evidence) union all (select record_id, 'b' from evidence except select record_id, 'b' from obs)")
def u2(t):
    return T.key_difference(t.obs, t.evidence, ["record_id"])


@query("u3_key_intersection", "select record_id from obs intersect select record_id from evidence")
def u3(t):
    return T.key_intersection(t.obs, t.evidence, ["record_id"])


@query("s8_read_record_evidence", "select record_id, source_id, license, title as dataset_title from evidence")
def s8(t):
    path = scratch(t)
    t.evidence.withColumn("dataset_title", F.col("title")).write.json(path)
    return T.read_record_evidence(t.spark, path).select("record_id", "source_id", "license", "dataset_title")


def bundles(t):
    """Bundles of bounded size, samples of one dataset made its own, with a planted repeated and a dangling key.

    Each source has one with its dataset, files, events, methods, publication and acquisition run, and a part for each
    sample, its observations and their line.

    A record's id begins with its sample's key, by which the rows are dealt when their tables are joined: repeats of a record
    (the one that comes first by value and element stays) and the rows of a part are gathered where they lie. Whole rows are
    compared, so that heads and parts ask the joins for the same columns and share the files of their shuffles.
    """
    wanted = ("record_id", "sample_id", "source_id", "title", "license", "method_family", "element", "value", "medium", "lithology", "source_row")
    rows = t.keyed.select("sample_key", F.struct(*wanted).alias("row"))
    first = F.min_by("row", F.struct(F.col("row.value").isNull(), "row.value", "row.element"))
    o = rows.groupBy("sample_key", F.col("row.record_id").alias("record")).agg(first.alias("row")).select("sample_key", "row.*").withColumn("sid", F.concat_ws("/", "source_id", "sample_id"))
    files = F.array(F.struct(F.lit("file-1").alias("file_id"), F.lit("h").alias("sha256")))
    events = F.array(F.struct(F.concat(F.lit("e-"), "source_id").alias("event_id"), F.col("title").alias("place")))
    fam = F.array(*[F.struct(F.concat(F.col("source_id"), F.lit(f"/{m}")).alias("method_id"), F.lit(m).alias("family"), F.when(F.lit(m == "xrf"), F.array(F.concat(F.lit("pub-"), "source_id"))).otherwise(F.array().cast("array<string>")).alias("publication_ids")) for m in ("icp_ms", "xrf")])
    own = F.array("source_id").alias("dataset_ids")
    papers = F.array(F.struct(F.concat(F.lit("pub-"), "source_id").alias("publication_id"), F.concat(F.lit("Survey of "), "title").alias("citation"), F.concat(F.lit("doi 10/"), "source_id").alias("doi"), own, F.array(F.lit("describes"), F.lit("cites")).alias("relation_types")))
    runs = F.array(F.struct(F.concat(F.lit("run-"), "source_id").alias("acquisition_run_id"), F.lit("complete").alias("status"), own))
    line = F.array(F.struct(F.concat(F.lit("p-"), "sid").alias("provenance_id"), F.concat(F.lit("run-"), "source_id").alias("acquisition_run_id"), F.col("sid").alias("source_record_id"), "source_row"))
    heads = o.select("source_id", "title", "license").distinct().select(F.struct(F.col("source_id").alias("dataset_id"), "title", "license").alias("dataset"), files.alias("files"), events.alias("events"), fam.alias("methods"), papers.alias("publications"), runs.alias("acquisition_runs"))
    observation = F.struct(F.concat(F.lit("p-"), "sid").alias("provenance_id"), F.col("record_id").alias("observation_id"), F.col("sid").alias("sample_id"), F.concat(F.col("source_id"), F.lit("/"), "method_family").alias("method_id"), "element", "value")
    event = F.when(F.length("sid") % 5 != 0, F.concat(F.lit("e-"), "source_id")).otherwise("e-none")
    parts = o.groupBy("sample_key", "source_id", "sid").agg(F.min("medium").alias("medium"), F.min("lithology").alias("lithology"), F.min("source_row").alias("source_row"), F.collect_list(observation).alias("observations")).select(
        F.col("source_id").alias("part_of"), F.array(F.struct(F.col("sid").alias("sample_id"), event.alias("event_id"), "medium", "lithology")).alias("samples"), "observations", line.alias("lineage"),
    )
    return heads.select(F.to_json(F.struct("*")).alias("bundle")).union(parts.select(F.to_json(F.struct("*")).alias("bundle")))


#: The archive's tables in SQL, written down from the same rules.
ARCH = """
, ob as (select distinct on (record_id) record_id, source_id, title, license, source_id || '/' || sample_id as sid, medium, source_id || '/' || method_family as mid, method_family, element, value, lithology, source_row from obs order by record_id, value, element),
sa as (select source_id, sid, min(medium) as medium, min(lithology) as lithology, min(source_row) as source_row, case when length(sid) % 5 <> 0 then 'e-' || source_id else 'e-none' end as eid from ob group by source_id, sid),
srch as (select record_id as observation_id, ob.sid as sample_id, element, ob.value, sa.medium, method_family as family, ob.source_id as dataset_id, title, license from ob join sa on ob.sid = sa.sid where sa.eid <> 'e-none' and method_family <> 'aas')
"""


@query("s9_explode_archive_bundle", ARCH + "select source_id as dataset_id, count(*) as samples, cast((select count(*) from ob where ob.source_id = sa.source_id) as bigint) as observations from sa group by 1")
def s9(t):
    a = T.explode_archive_bundle(bundles(t))
    s = a["samples"].groupBy("dataset_id").agg(F.count("*").alias("samples"))
    return s.join(a["observations"].groupBy("dataset_id").agg(F.count("*").alias("observations")), "dataset_id")


def _view(t, name):
    return T.archive_views(T.explode_archive_bundle(bundles(t)), [name])[name]


@query("s10_archive_views", ARCH + "select dataset_id, title, count(*) as observations, count(distinct sample_id) as samples, count(distinct element) as elements from srch group by 1, 2")
def s10(t):
    return _view(t, "source_coverage")


@query("s10_observation_search", ARCH + "select * from srch")
def s10_search(t):
    found = _view(t, "observation_search")
    return found.select("observation_id", "sample_id", "element", "value", "medium", "family", "dataset_id", "title", "license")


@query("s10_sample_summary", ARCH + "select sa.sid as sample_id, sa.medium, count(*) as observations, string_agg(distinct element, ',' order by element) as elements from sa join ob on ob.sid = sa.sid group by all")
def s10_summary(t):
    return _view(t, "sample_summary").withColumn("elements", F.concat_ws(",", "elements"))


@query("s10_provenance_trace", ARCH + "select record_id as observation_id, ob.source_id as dataset_id, title, license, cast(1 as bigint) as files, 'p-' || ob.sid as provenance_id, 'run-' || ob.source_id as acquisition_run_id, ob.sid as source_record_id, sa.source_row, 'complete' as status from ob join sa on ob.sid = sa.sid")
def s10_trace(t):
    return _view(t, "provenance_trace").drop("input_sha256")


@query("s9_archive_links", ARCH + """, src as (select distinct source_id as d from ob)
select 'publication_datasets' as link, 'pub-' || d as one, d as other, unnest(['describes', 'cites']) as relation from src
union all select 'method_publications', d || '/xrf', 'pub-' || d, null from src
union all select 'run_datasets', 'run-' || d, d, null from src
union all select 'lineage', 'p-' || sid, 'run-' || source_id, null from sa""")
def s9_links(t):
    a = T.explode_archive_bundle(bundles(t))
    keys = {"publication_datasets": ("publication_id", "dataset_id", "relation_type"), "method_publications": ("method_id", "publication_id"), "run_datasets": ("acquisition_run_id", "dataset_id"), "lineage": ("provenance_id", "acquisition_run_id")}
    parts = [a[k].select(F.lit(k).alias("link"), F.col(c[0]).alias("one"), F.col(c[1]).alias("other"), (F.col(c[2]) if c[2:] else F.lit(None).cast("string")).alias("relation")) for k, c in keys.items()]
    return T.union_by_name(parts)


#: What each entity is found by, and which have all words of a search.
ENTITIES = ARCH + r"""
, ents as (select distinct 'dataset' as kind, source_id as entity_id, concat_ws(' ', title, source_id) as text from ob
 union all select distinct 'publication', 'pub-' || source_id, concat_ws(' ', 'Survey of ' || title, 'doi 10/' || source_id) from ob
 union all select distinct 'event', 'e-' || source_id, title from ob
 union all select 'sample', sid, concat_ws(' ', sid, medium, lithology) from sa
 union all select distinct 'method', source_id || '/' || m, m from ob cross join (values ('icp_ms'), ('xrf')) v(m)
 union all select 'document', cast(doc_id as varchar), text from documents),
hits as (select q, kind, entity_id from ents, (values ('the and', ['the', 'and']), ('Granite SOIL', ['granite', 'soil']), ('title 1', ['title', '1']), ('xrf', ['xrf']), ('doi survey', ['doi', 'survey'])) s(q, w) where list_has_all(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), w))"""


def _indexed(t, more=None):
    """An archive and the place of the index of its entities and ``more``."""
    archive, path = T.explode_archive_bundle(bundles(t)), scratch(t)
    entities = I.archive_entities(archive)
    I.build_index(entities.union(more) if more is not None else entities, path, stored=True)
    return archive, path


@query("f11_indexed_search", ENTITIES + " select * from hits")
def f11_index(t):
    _, path = _indexed(t, t.documents.select(F.lit("document"), F.col("doc_id").cast("string"), "text"))
    searches = ("the and", "Granite SOIL", "title 1", "xrf", "doi survey")
    return T.union_by_name([I.search_index(t.spark, path, q).select(F.lit(q).alias("q"), "kind", "entity_id") for q in searches])


@query("f10_archive_text", ENTITIES + """
, found as (select * from hits where q in ('Granite SOIL', 'doi survey') and kind <> 'document' or q = 'title 1' and kind = 'event')
select observation_id, sample_id from srch where sample_id in (select entity_id from found where kind = 'sample') or dataset_id in (select entity_id from found where kind = 'dataset')
 or 'e-' || dataset_id in (select entity_id from found where kind = 'event') or dataset_id || '/' || family in (select entity_id from found where kind = 'method')
 or family = 'xrf' and 'pub-' || dataset_id in (select entity_id from found where kind = 'publication')""")
def f10_archive(t):
    archive, path = _indexed(t)
    hits = [I.search_index(t.spark, path, q, kinds) for q, kinds in (("Granite SOIL", None), ("doi survey", None), ("title 1", ["event"]))]
    return I.observations_found(archive, T.union_by_name(hits)).select("observation_id", "sample_id")


@query("s11_export_flat", ARCH + "select observation_id as record_id, sample_id, medium, family as method_family, dataset_id as source_id, title, license, case when value is null then 'not_reported' end as missing_reason from srch")
def s11(t):
    return T.export_flat(T.explode_archive_bundle(bundles(t))).drop("value", "element_or_analyte")


@query("a60_archive_integrity", ARCH + """
select 'files' as "table", 'file-1' as key, 'repeated_key' as problem, (select count(distinct source_id) from ob) as n
union all select 'samples', 'e-none', 'no_events', count(*) from sa where eid = 'e-none' having count(*) > 0
union all select 'observations', mid, 'no_methods', count(*) from ob where method_family = 'aas' group by mid""")
def a60(t):
    return T.archive_integrity(T.explode_archive_bundle(bundles(t)))


@query("s12_write_canonical", """select case when qualifier = 'lt' then 'true' else 'false' end as censored, record_id, '["' || element || '","' || medium || '"]' as tags, cast(source_row as varchar) as value from obs""")
def s12(t):
    path = scratch(t)
    df = t.obs.select("record_id", F.col("source_row").alias("value"), F.array("element", "medium").alias("tags"), (F.col("qualifier") == "lt").alias("censored"))
    T.write_canonical(df, path, "csv", ["censored", "record_id", "tags", "value"])
    return t.spark.read.option("header", True).option("escape", '"').csv(path)


@query("s13_to_geojson_features", """select '{"type":"Feature","geometry":' || case when lon is null then 'null' else '{"type":"Point","coordinates":[' || cast(source_row % 90 as varchar) || ',' || cast(source_row % 80 as varchar) || ']}' end || ',"properties":{"record_id":"' || record_id || '","lithology":' || coalesce('"' || lithology || '"', 'null') || '}}' as feature from obs""")
def s13(t):
    df = t.obs.withColumns({"x": F.when(F.col("lon").isNotNull(), F.col("source_row") % 90), "y": F.col("source_row") % 80})
    return T.to_geojson_features(df, "x", "y", ["record_id", "lithology"])


@query("s14_file_manifest")
def s14(t):
    path = scratch(t)
    t.obs.select("source_id", "record_id").repartition("source_id").write.partitionBy("source_id").csv(path)
    return T.file_manifest(t.spark, f"{path}/*/*.csv")


@query("s15_manifest_diff", "select record_id as path, case when source_row % 10 = 0 then 'removed' when source_row % 10 = 1 then 'added' else 'changed' end as change from obs where source_row % 10 < 2 or source_row % 10 = 2 and license is not null")
def s15(t):
    o = t.obs
    k = F.col("source_row") % 10
    before = o.filter(k != 1).select(F.col("record_id").alias("path"), F.coalesce("license", F.lit("-")).alias("sha256"))
    after = o.filter(k != 0).select(F.col("record_id").alias("path"), F.when((k == 2) & F.col("license").isNotNull(), "new").otherwise(F.coalesce("license", F.lit("-"))).alias("sha256"))
    return T.manifest_diff(before, after)


@query("f10_query_observations", r"""select distinct record_id, sampled_at from obs where element in ('As','Pb') and medium in ('soil') and (lon >= -100 and lon <= 150) and lat between -60 and 70 and sampled_at >= '1994-01-01' and sampled_at <= '1998-12-31'
 and (coalesce(lithology in ('granite', 'basalt'), false) or coalesce(sample_type in ('core'), false)) and list_has_all(string_split_regex(lower(concat_ws(' ', title, method_family, basis)), '[^\p{L}\p{N}]+'), ['title', 'xrf']) order by 1, 2 limit 500""")
def f10(t):
    return T.query_observations(
        t.obs, filters={"element": ["As", "Pb"], "medium": ["soil"]}, any_of={"lithology": ["granite", "basalt"], "sample_type": ["core"]}, box=(-100.0, -60.0, 150.0, 70.0), time_from="1994-01-01", time_to="1998-12-31",
        text="XRF, title", text_columns=["title", "method_family", "basis"], columns=["record_id", "sampled_at"], limit=500,
    )


@query("f11_text_search", r"select doc_id as entity_id from documents where list_contains(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), 'the') and list_contains(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), 'and')")
def f11(t):
    return T.text_search(t.documents.select(F.col("doc_id").alias("entity_id"), "text"), "and THE")


@query("f4_box_of_layout", "select record_id, element, medium, lon, lat from obs where element in ('As', 'Pb') and medium = 'soil' and (lon >= 100 or lon <= -120) and lat between -40.5 and 35")
def f4_layout(t):
    path = scratch(t)
    L.write_by_place(t.obs, path, level=2)
    return L.read_by_place(t.spark, path, (100.0, -40.5, -120.0, 35.0), medium=["soil"], element=["As", "Pb"]).select("record_id", "element", "medium", "lon", "lat")


@query("f12_declared_coverage_subset", "select record_id from obs where lon is not null or source_id in ('src-0')")
def f12(t):
    declared = t.spark.createDataFrame([("src-0", ["A", "B"]), ("src-1", ["A", "Z"]), ("src-2", [])], "source_id string, countries array<string>")
    return T.declared_coverage_subset(t.obs, declared, ["A", "B", "C"]).select("record_id")
