"""Archive bundles stay small however many rows a source has, and parts of a dataset explode like one bundle."""

import json
import os

import pytest

from obskit.plans import archive
from obskit.plans.base import Tables
from obskit.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_bundles_are_bounded_and_whole(spark):
    t = Tables(spark, SF)
    found = [json.loads(r.bundle) for r in archive.bundles(t).collect()]
    obs = t.obs.select("record_id", "source_id", "sample_id").collect()
    lines = {}
    for r in obs:
        lines[r.source_id, r.sample_id] = lines.get((r.source_id, r.sample_id), 0) + 1
    assert max(len(b.get("observations", [])) for b in found) <= max(lines.values()) and max(len(b.get("samples", [])) for b in found) == 1
    assert sorted(o["observation_id"] for b in found for o in b.get("observations", [])) == sorted({r.record_id for r in obs})
    assert len([b for b in found if "samples" in b]) == len(lines)


def test_parts_belong_to_their_dataset(spark):
    whole = {"dataset": {"dataset_id": "d", "title": "t", "license": "l"}, "samples": [{"sample_id": "s1", "event_id": "e", "medium": "soil"}]}
    part = {"part_of": "d", "samples": [{"sample_id": "s2", "event_id": "e", "medium": "rock"}], "observations": [{"observation_id": "o", "sample_id": "s2"}]}
    out = tables.explode_archive_bundle(spark.createDataFrame([(json.dumps(b),) for b in (whole, part)], "bundle string"))
    assert [tuple(r) for r in out["datasets"].collect()] == [("d", "t", "l")]
    assert sorted((r.dataset_id, r.sample_id) for r in out["samples"].collect()) == [("d", "s1"), ("d", "s2")]
    assert [(r.dataset_id, r.observation_id) for r in out["provenance"].collect()] == [("d", "o")]
