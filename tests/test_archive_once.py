"""An archive is parsed once, whatever number of tables is read from it."""

import json

from pyspark.sql import functions as F

from obskit.sources import tables


def bundle(i):
    head = {"dataset": {"dataset_id": f"d{i}", "title": "t", "license": "l"}, "events": [{"event_id": f"e{i}"}], "methods": [{"method_id": f"m{i}", "publication_ids": []}]}
    return [head, {"part_of": f"d{i}", "samples": [{"sample_id": f"s{i}", "event_id": f"e{i}"}], "observations": [{"observation_id": f"o{i}", "sample_id": f"s{i}", "method_id": f"m{i}"}]}]


def test_bundles_are_computed_once(spark):
    rows = spark.createDataFrame([(json.dumps(b),) for i in range(20) for b in bundle(i)], "bundle string")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    archive = tables.explode_archive_bundle(rows.mapInArrow(count, "bundle string"))
    assert tables.archive_integrity(archive).collect() == []
    assert tables.archive_views(archive)["observation_search"].count() == 20
    assert read.value == 40


def test_odd_bundles_keep_their_tables(spark):
    odd = [{"part_of": "d", "files": [{"file_id": "f"}]}, {"part_of": "d", "publications": [{"publication_id": "p", "dataset_ids": ["d"], "relation_types": ["cites"]}]}, {"samples": [{"sample_id": "s"}]}, {}]
    out = tables.explode_archive_bundle(spark.createDataFrame([(json.dumps(b),) for b in odd], "bundle string"))
    assert [tuple(r) for r in out["datasets"].collect()] == [(None, None, None)] * 2
    assert [(r.dataset_id, r.file_id) for r in out["files"].collect()] == [("d", "f")]
    assert [tuple(r) for r in out["publication_datasets"].collect()] == [("p", "d", "cites")]
    assert out["samples"].select(F.col("sample_id")).first()[0] == "s"
