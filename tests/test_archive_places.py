"""What belongs together meets in the bundle that holds it, and what is spread over bundles is found all the same."""

import json
import os
from collections import Counter

import pytest

from obskit.plans import archive
from obskit.plans.base import Tables
from obskit.sources import search, storage, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sample(i, medium="soil", event="e"):
    return {"sample_id": i, "event_id": event, "medium": medium}


def observation(i, s, line=None, element="As", method="m"):
    return {"observation_id": i, "sample_id": s, "method_id": method, "element": element, "provenance_id": line}


def line(i, run="r"):
    return {"provenance_id": i, "acquisition_run_id": run, "source_row": 1}


HEAD = {"dataset": {"dataset_id": "d", "title": "t", "license": "l"}, "files": [{"file_id": "f"}, {"file_id": "f"}], "events": [{"event_id": "e"}], "methods": [{"method_id": "m", "family": "xrf", "publication_ids": []}], "acquisition_runs": [{"acquisition_run_id": "r", "status": "ok", "dataset_ids": ["d"]}]}
NEAT = [HEAD] + [{"part_of": "d", "samples": [sample(f"s{i}")], "observations": [observation(f"o{i}-{k}", f"s{i}", f"p{i}", e) for k, e in enumerate(("Pb", "As", "Pb"))], "lineage": [line(f"p{i}")]} for i in range(30)]
ODD = NEAT + [
    {"part_of": "d", "samples": [sample("far")], "lineage": [line("q")]}, {"part_of": "d", "observations": [observation("f1", "far", "q"), observation("f2", "nowhere", "none"), observation(None, None)]},
    {"part_of": "d", "samples": [sample("s1", "rock"), sample("s2")], "observations": [observation("x1", "s2", "p2"), observation("o1-0", "s3", "p3", None)]},
    {"part_of": "d", "samples": [sample("twice"), sample("twice"), sample(None), sample(None, "rock")], "observations": [observation("t1", "twice", "two"), observation(None, "twice", None)], "lineage": [line("two"), line("two", "gone"), line(None)]},
    {"part_of": "d", "samples": [sample(f"m{i}", event="e" if i % 2 else "lost") for i in range(12)], "observations": [observation(f"mo{i}", f"m{i % 12}", f"ml{i}", method="m" if i % 3 else "lost") for i in range(20)], "lineage": [line(f"ml{i}") for i in range(15)]},
    {"part_of": "d", "samples": [sample("alone")]}, {"part_of": "other", "samples": [sample("o")], "observations": [observation("oo", "o", "po")], "lineage": [line("po")]},
]


def exploded(spark, bundles):
    return tables.explode_archive_bundle(spark.createDataFrame([(json.dumps(b),) for b in bundles], "bundle string"))


def told(df):
    return Counter(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


def plain(bundles):
    """The summary, search and trace of bundles, by loops."""
    every = lambda name: [(b.get("part_of", "d"), x) for b in bundles for x in b.get(name, [])]
    samples, observations, lines = every("samples"), every("observations"), every("lineage")
    groups = {}
    for _, s in samples:
        own = [o for _, o in observations if s["sample_id"] is not None and o["sample_id"] == s["sample_id"]]
        n, e = groups.get((s["sample_id"], s["medium"]), (0, set()))
        groups[s["sample_id"], s["medium"]] = n + sum(o["observation_id"] is not None for o in own), e | {o["element"] for o in own} - {None}
    summary = Counter((str(sorted(e)), str(m), str(n), str(s)) for (s, m), (n, e) in groups.items())
    met = Counter((o["observation_id"], s["sample_id"], s["medium"]) for d, o in observations for _, s in samples if d == "d" and o["sample_id"] is not None and o["sample_id"] == s["sample_id"] and s["event_id"] == "e" and o["method_id"] == "m")
    trace = Counter()
    for d, o in observations:
        own = [x for _, x in lines if o["provenance_id"] is not None and x["provenance_id"] == o["provenance_id"]]
        for x in (own or [{"acquisition_run_id": None}]) if d == "d" else []:
            trace[o["observation_id"], o["provenance_id"], x["acquisition_run_id"], "ok" if x["acquisition_run_id"] == "r" else None, 2] += 1
    return summary, met, trace


@pytest.mark.parametrize("bundles", [NEAT, ODD], ids=["neat", "odd"])
@pytest.mark.parametrize("how", ["in bundles", "by keys", "too many strays"])
def test_views_of_spread_bundles(spark, monkeypatch, bundles, how):
    if how == "too many strays":
        monkeypatch.setattr(tables, "STRAYS", -1)
    found = exploded(spark, bundles)
    views = tables.archive_views(dict(found) if how == "by keys" else found)
    summary, met, trace = plain(bundles)
    assert told(views["sample_summary"]) == summary
    assert Counter(tuple(r) for r in views["observation_search"].select("observation_id", "sample_id", "medium").collect()) == met
    assert Counter(tuple(r) for r in views["provenance_trace"].select("observation_id", "provenance_id", "acquisition_run_id", "status", "files").collect()) == trace
    (cover,) = views["source_coverage"].collect()
    assert (cover.observations, cover.samples) == (sum(met.values()), len({m[1] for m in met}))


def test_views_shuffle_no_observations(spark):
    views = tables.archive_views(exploded(spark, NEAT))
    for name in ("observation_search", "sample_summary"):
        assert "Exchange hashpartitioning" not in plan(views[name]) and "SortMergeJoin" not in plan(views[name])
    assert "hashpartitioning(provenance_id" not in plan(views["provenance_trace"])
    assert "Exchange hashpartitioning" not in plan(tables.export_flat(exploded(spark, NEAT)))


def test_replaced_tables_are_met_by_keys(spark):
    found = exploded(spark, NEAT)
    found["observations"] = found["observations"].filter("observation_id = 'o1-1'")
    views = tables.archive_views(found)
    assert [r.observation_id for r in views["observation_search"].collect()] == ["o1-1"]
    assert sorted(r.observations for r in views["sample_summary"].collect()) == [0] * 29 + [1]


@pytest.mark.parametrize("how", ["in bundles", "by keys"])
def test_integrity_of_spread_bundles(spark, how):
    found = exploded(spark, ODD)
    got = Counter(tuple(r) for r in tables.archive_integrity(found if how == "in bundles" else dict(found)).collect())
    every = lambda name: [x for b in ODD for x in b.get(name, [])]
    want = Counter({("files", "f", "repeated_key", 2): 1, ("samples", "lost", "no_events", 6): 1, ("observations", "lost", "no_methods", 7): 1})
    for name, key in (("samples", "sample_id"), ("observations", "observation_id"), ("lineage", "provenance_id"), ("datasets", "dataset_id")):
        keys = [None] * 0 if name == "datasets" else [x[key] for x in every(name)]
        want.update((name, k, "repeated_key", n) for k, n in Counter(keys).items() if n > 1)
    want.update([("observations", "nowhere", "no_samples", 1), ("observations", None, "no_samples", 1), ("provenance", None, "no_observations", 2), ("lineage", "gone", "no_acquisition_runs", 1)])
    assert got == want


def test_integrity_shuffles_hashes_of_long_tables(spark):
    out = tables.archive_integrity(exploded(spark, NEAT))
    assert "hashpartitioning(observation_id" not in plan(out) and [tuple(r) for r in out.collect()] == [("files", "f", "repeated_key", 2)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_bundles_are_dealt_once(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "4000")  # suppliers are few, orders are not
    try:
        found = archive.bundles(Tables(spark, SF))
        found.collect()
        final = plan(found).split("Initial Plan")[0]
    finally:
        spark.conf.set(name, before)
    dealt = [x.split("hashpartitioning")[1].split("#")[0] for x in final.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    # Rows by the key they are joined by, once for heads and parts, and the few heads.
    assert "SortMergeJoin" in final and final.count("ReusedExchange") >= 2 and sorted(dealt) == ["(l_orderkey", "(o_orderkey", "(source_id"]


def test_index_of_stored_entities_writes_no_copy(spark, tmp_path):
    before = len(storage._made)
    rows = [("sample", f"e{i}", f"common w{i % 7}") for i in range(400)]
    for stored in (True, False):
        path = str(tmp_path / str(stored))
        search.build_index(spark.createDataFrame(rows, "kind string, entity_id string, text string"), path, buckets=8, block=50, stored=stored)
        assert len(storage._made) == before + (not stored)
        assert sorted(r.entity_id for r in search.search_index(spark, path, "W3 common").collect()) == sorted(e for _, e, w in rows if w.endswith("w3"))


def test_rows_found_otherwise_do_not_meet_samples(spark):
    found = exploded(spark, ODD)
    hits = spark.createDataFrame([("method", "nothing"), ("sample", "far"), ("sample", "s2"), ("event", "absent")], "kind string, entity_id string")
    assert sorted(r.observation_id for r in search.observations_found(found, hits).collect()) == sorted(["f1"] + 2 * ["o2-0", "o2-1", "o2-2", "x1"])
    both = hits.union(spark.createDataFrame([("dataset", "d")], hits.schema))
    out = search.observations_found(found, both)
    every = Counter(r.observation_id for r in tables.archive_views(found)["observation_search"].collect())
    assert Counter(r.observation_id for r in out.collect()) == every and "LeftSemi" in plan(out)
