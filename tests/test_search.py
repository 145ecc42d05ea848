"""The stored word index against a plain search; which of its files a search reads."""

import json
import re

import pytest
from pyspark.sql import functions as F

from obskit.sources import search, tables


def plain(rows, query):
    wanted = set(tables.distinct_words(query))
    texts = {}
    for kind, key, text in rows:
        if key is not None:
            texts.setdefault((kind, key), set()).update(re.split(r"[\W_]+", (text or "").lower()))
    return sorted(k for k, words in texts.items() if wanted and wanted <= words)


ROWS = [(("sample", "method", "dataset")[i % 3], f"e{i}", " ".join(["Common"] + [w for k, w in enumerate(("Ärger", "alpha-2", "beta", "Gamma_x")) if i % (k + 2) == 0])) for i in range(300)]
ROWS += [("sample", "none", None), ("sample", "empty", ""), ("sample", None, "common beta"), ("method", "twice", "beta"), ("method", "twice", "zeta"), ("method", "twice", "beta")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "words")
    search.build_index(spark.createDataFrame(ROWS, "kind string, entity_id string, text string"), path, buckets=16, block=20)
    return path


@pytest.mark.parametrize("query", ["common", "ÄRGER", "alpha", "2 Alpha", "beta zeta", "gamma, beta; alpha", "x", "absent", "common absent", "", " -- "])
def test_search_is_the_plain_one(spark, index, query):
    found = sorted((r.kind, r.entity_id) for r in search.search_index(spark, index, query).collect())
    assert found == plain(ROWS, query)


def test_kinds_are_kept_apart(spark, index):
    found = search.search_index(spark, index, "common", ["method"]).collect()
    assert {r.kind for r in found} == {"method"} and len(found) == 100


def test_a_search_reads_the_folders_of_its_words(spark, index):
    wanted = {r.b for r in spark.createDataFrame([("beta",), ("zeta",)], "w string").select(F.expr("pmod(xxhash64(w), 16)").alias("b")).collect()}
    scanned = search._lists(spark, index, ["beta", "zeta"], None)
    folders = set(scanned.select(F.regexp_extract(F.input_file_name(), r"bucket=(\d+)", 1).cast("int").alias("f")).distinct().toPandas().f)
    assert folders == wanted
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan) and "xxhash64" not in plan and "PushedFilters: [In(token" in plan
    every = spark.read.parquet(f"{index}/postings").select("bucket").distinct().count()
    assert len(folders) < every


def test_no_list_outgrows_its_block(spark, index):
    postings = spark.read.parquet(f"{index}/postings").filter("token = 'common'")
    sizes = [r.n for r in postings.select(F.size("ids").alias("n")).collect()]
    assert sum(sizes) == 300 and len(sizes) > 30 and max(sizes) <= 20
    assert postings.groupBy("token", "kind", "block").count().filter("count > 1").isEmpty()


def test_empty_index(spark, tmp_path):
    path = str(tmp_path / "none")
    search.build_index(spark.createDataFrame([], "kind string, entity_id long, text string"), path)
    assert search.search_index(spark, path, "common").collect() == []


def test_index_broken_off_is_not_read(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "half" / "postings"))
    with pytest.raises(Exception, match="shape"):
        search.search_index(spark, str(tmp_path / "half"), "common").collect()


def test_observations_by_each_kind(spark, tmp_path):
    def bundle(d, paper):
        methods = [{"method_id": f"{d}-m{i}", "family": f, "publication_ids": paper if i else []} for i, f in enumerate(("icp", "xrf"))]
        obs = [{"observation_id": f"{d}-o{i}", "sample_id": f"{d}-s{i % 2}", "method_id": f"{d}-m{i // 2}", "element": "As"} for i in range(4)]
        samples = [{"sample_id": f"{d}-s{i}", "event_id": f"{d}-e", "medium": m} for i, m in enumerate(("soil", "rock"))]
        papers = [{"publication_id": p, "citation": f"On {p}", "dataset_ids": [d], "relation_types": ["cites", "describes"]} for p in paper]
        return json.dumps({"dataset": {"dataset_id": d, "title": f"title of {d}"}, "samples": samples, "events": [{"event_id": f"{d}-e", "place": f"hill {d}"}], "methods": methods, "observations": obs, "publications": papers})

    archive = tables.explode_archive_bundle(spark.createDataFrame([(bundle("a", ["pa"]),), (bundle("b", []),)], "bundle string"))
    assert sorted(tuple(r) for r in archive["publication_datasets"].collect()) == [("pa", "a", "cites"), ("pa", "a", "describes")]
    path = str(tmp_path / "words")
    search.build_index(search.archive_entities(archive), path)

    def found(query, *kinds):
        hits = search.search_index(spark, path, query, kinds)
        return sorted(r.observation_id for r in search.observations_found(archive, hits).collect())

    assert found("title b", "dataset") == ["b-o0", "b-o1", "b-o2", "b-o3"]
    assert found("hill a", "event") == ["a-o0", "a-o1", "a-o2", "a-o3"]
    assert found("rock", "sample") == ["a-o1", "a-o3", "b-o1", "b-o3"]
    assert found("xrf", "method") == ["a-o2", "a-o3", "b-o2", "b-o3"]
    assert found("pa", "publication") == ["a-o2", "a-o3"]
    assert found("a", "dataset", "sample", "method", "event") == ["a-o0", "a-o1", "a-o2", "a-o3"]
    assert found("nothing") == []
