"""The stages of the corpus pipeline, one after another, each against brute force on its own input."""

import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def test_stages_match_brute_force(spark):
    import corpus_pipeline as cp
    from obskit.llm import mixing, pieces, toxicity
    from obskit.llm.common import durable, held_out, table
    from tests.llm.test_operators import brute_print, nearest_rates

    docs = table(spark, SF, "documents")
    columns, docs_schema, seen = docs.columns, docs.schema, {"documents": docs.collect()}
    for name, stage in cp.STAGES:
        docs = durable(stage(spark, docs, SF))
        seen[name] = docs.collect()
        assert name == "sentencepiece" or docs.columns == columns
    toxic = {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 1").collect()}
    clean = [r for r in seen["documents"] if r.doc_id not in toxic]
    passed = {r.doc_id for r in seen["toxicity"]}
    assert len([r for r in clean if r.doc_id in passed]) >= 0.97 * len(clean)
    model = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), ~held_out(F.col("doc_id")))
    dropped = {r.doc_id for r in seen["documents"]} - passed
    assert dropped == {r.doc_id for r in seen["documents"] if model.score(r.text or "") >= cp.TOXIC}

    last = {}
    for r in seen["toxicity"]:
        key = "".join(c.lower() if c.isascii() else c for c in r.text or "")
        last[key] = max(last.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in seen["exact_dedup"]) == sorted(last.values())

    prints = {r.doc_id: brute_print(r.text or "") for r in seen["exact_dedup"]}
    prints = {i: int(p, 16) if isinstance(p, str) else p for i, p in prints.items()}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert sorted(r.doc_id for r in seen["simhash_near_dedup"]) == sorted({find(i) for i in ids})

    before = spark.createDataFrame(seen["simhash_near_dedup"], docs_schema)
    mixed = mixing.mix(before, table(spark, SF, "labels").select("doc_id", (1 - F.col("quality")).alias("domain")), cp.QUALITY).collect()
    n, rate, p = np.array([r.n_tokens for r in mixed]), np.array([r.rate for r in mixed]), np.array([r.posterior for r in mixed])
    assert np.allclose((n * rate) @ p / n.sum(), list(cp.QUALITY.values()), atol=1e-4)
    assert np.allclose(rate, nearest_rates(n, p, np.array(list(cp.QUALITY.values())) * n.sum()), atol=1e-3)
    assert all(math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1 for r in mixed)
    assert Counter(r.doc_id for r in seen["mixing"]) == {r.row.doc_id: r.copies for r in mixed if r.copies}
    texts = {r.doc_id: r.text or "" for r in seen["mixing"]}
    back = pieces.decode(docs).collect()
    assert sorted(r.doc_id for r in back) == sorted(r.doc_id for r in seen["mixing"])
    assert all(r.decoded == texts[r.doc_id] and r.n_tokens == len(r.token_ids) for r in back)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_toxic_documents_go_and_no_others(spark):
    import corpus_pipeline as cp
    from obskit.llm import toxicity
    from obskit.llm.common import held_out, table

    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels, ~held_out(F.col("doc_id")))
    rows = docs.select("doc_id", "text").collect()
    stay = {r.doc_id for r in cp.drop_toxic(spark, docs, sf).select("doc_id").collect()}
    assert {r.doc_id for r in rows} - stay == {r.doc_id for r in rows if model.score(r.text or "") >= cp.TOXIC}
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()} & {r.doc_id for r in rows}
    # 400 labels teach 33 of these 51; with 4,000 it is 91 of 97 held-out ones.
    assert toxic and len(toxic - stay) >= 0.6 * len(toxic)


def test_pipeline_stands_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as cp
    from obskit.llm import pieces

    docs_type, labels_type = "doc_id bigint, text string, lang string, source string, n_chars bigint", "doc_id bigint, quality int, toxic int"
    words = "the of and plain words in a text that says nothing much at all to anyone who reads it today".split()
    texts = {i: " ".join(words[(i * k) % len(words)] for k in range(1, 60 + i)) for i in range(30)}
    rows = [(i, t, "en", "hot", len(t)) for i, t in texts.items()] + [(40, texts[3], "en", "hot", 1), (41, None, None, None, None), (None, "no id here but some words", "en", "s", 1), (None, None, None, None, None), (42, "", "en", "s", 0), (42, "same id, other text", "en", "s", 1)]
    marks = [(i, int(i % 3 != 0), 0) for i in range(30)] + [(41, None, None), (None, 1, 1), (7, 9, 9)]
    for name, data, labels in (("odd", rows, marks), ("unlabelled", rows, []), ("empty", [], [])):
        spark.createDataFrame(data, docs_type).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, labels_type).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = pieces.decode(cp.run(spark, f"{tmp_path}/{name}")).collect()
        assert {r.decoded for r in out} <= {t or "" for _, t, *_ in data} and all(r.n_tokens == len(r.token_ids) for r in out)
        assert bool(out) == bool(data)


def test_stages_keep_clashing_columns_and_a_very_long_text(spark, tmp_path):
    import corpus_pipeline as cp
    from obskit.llm import pieces
    from obskit.llm.common import durable, table

    extra = ("score", "row", "copies", "component_id", "kept", "rate", "n_tokens", "token_ids", "digest", "fingerprint")
    own = table(spark, SF, "documents").limit(60)
    long = " ".join(f"word{i % 9973} of a long report" for i in range(200_000))
    assert len(long) > 5_000_000
    more = spark.createDataFrame([(10**6, long, "en", "long", len(long))], own.schema)
    docs = own.union(more).withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in extra})
    docs.write.parquet(f"{tmp_path}/d/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{tmp_path}/d/labels.parquet")
    docs = table(spark, f"{tmp_path}/d", "documents")
    columns = docs.columns
    for name, stage in cp.STAGES:
        docs = durable(stage(spark, docs, f"{tmp_path}/d"))
        if name != "sentencepiece":
            assert docs.columns == columns
            assert all(r[c] == f"{c} of {r.doc_id}" for r in docs.select("doc_id", *extra).collect() for c in extra)
    back = {r.doc_id: r.decoded for r in pieces.decode(docs).collect()}
    assert 10**6 not in back or back[10**6] == long
