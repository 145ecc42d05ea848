"""The ten training-data operators against brute force, round trips and their defined cases."""

import hashlib
import os
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obskit.llm import chat, components, exact_index, features, mixing, pieces, quality_knn, quality_rules, sharding, simhash, suffix_dedup, toxicity
from obskit.llm.common import ascii_lower, held_out

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, schema=DOCS):
    rows = [(i, t, "en", "s0", len(t or "")) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    return spark.createDataFrame(rows, schema)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "the", "of", "Delta.", "épée", "zig,", "omega"]) + rng.choice(["", "x", "yy", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, a null id, clashing extra columns."""
    rng = random.Random(5)
    base = prose(rng, 80)
    rows = [(1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "x" * 5000), (9, prose(rng, 4000)), (9, "again"), (9, "again"), (None, base), (None, None), (10, base.replace("alpha", "ALPHA", 1) + " tail")]
    return spark.createDataFrame([(*r, "a", "b", 1, 0.5, True, "z") for r in rows], DOCS + ", score double, kept boolean, component_id string")


# ---------------------------------------------------------------- chat formatting


def test_chat_reads_back(spark):
    said = ["</s>[INST] ok [/INST]", "", " padded ", "[SEP]", "<\\/s> <\\\\/s>", "[ROLE=00] x [/ROLE]", "a<", "[", None, "line\nline", "[SYS]é[/SYS]", "\\", "<s> $1 \\$2"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool]", None, ""]), rng.choice(said)) for c in range(40) for t in range(rng.randint(1, 12))]
    rows += [(None, 0, "user", "lost"), (99, None, "user", "last"), (99, 0, "user", "first"), (98, 0, "user", "same"), (98, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segments", F.lit(1)).withColumn("turns", F.lit("x"))
    got = chat.format_chats(df).withColumn("t", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments"))).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert len(got) == len(want)
    for g in got:
        assert [tuple(t) for t in g.t] == want[g.conv_id]
        assert g.loss == "".join(x for r, x in want[g.conv_id] if r == "assistant")
        assert "".join(s.text for s in g.segments) == g.formatted
        runs = sum(1 for i, t in enumerate(want[g.conv_id]) if not i or want[g.conv_id][i - 1][0] != t[0])
        assert len(re.findall(r"\[INST\] |\[SYS\] |<s> |\[ROLE=[0-9A-F]*\] ", g.formatted)) == runs
    assert chat.format_chats(df.limit(0)).count() == 0


# ---------------------------------------------------------------- toxicity


def test_toxicity_grammar():
    m = toxicity.ToxicityModel({"idiot": 5.0, "oaf ": 4.0})
    assert m.features("a calm text. nothing here") == (0.0, 0.0, 0.0)
    plain, near, negated, reported = (m.features(t)[0] for t in ("what an idiot", "you are an idiot", "he is not an idiot", "she said what an idiot"))
    assert near > plain > reported > negated > 0
    assert m.features("some oafish thing")[0] == 0 and m.features("some oaf thing")[0] == 4.0
    assert m.features("i will kill you")[0] == m.threat and m.features("i will kill time")[0] == 0
    assert m.features("i will not kill you")[0] == m.threat * m.negated and m.features("he wrote: i would never hurt you")[0] == m.threat * m.negated * m.reported
    assert m.features("ich werde dich töten")[0] == m.features("je vais te tuer")[0] == m.threat and m.features("you killed time")[0] == 0
    both = toxicity.ToxicityModel({"you ": 5.0, "not ": 2.0})
    assert both.features("i will kill you")[0] == both.threat + 5.0, "a target stays one when it is an insult too"
    assert both.features("not a good thing to kill you")[0] == 2.0 + both.threat + 5.0 and both.features("not kill you")[0] == 2.0 + both.negated * (both.threat + 5.0)
    assert m.features("not this. idiot")[0] == 5.0, "negation ends with its clause"
    assert m.score("") == m.score("calm") < 0.5 < m.score("you idiot, you idiotic oaf")


def test_toxicity_machine_equals_its_parts_run_apart():
    rng = random.Random(12)
    whole, kinds = toxicity.grammar(), (0, 0, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.OBJECT, toxicity.NEGATION, toxicity.REPORT)
    for _ in range(400):
        words = [rng.choice(kinds) | rng.choice(kinds) for _ in range(rng.randint(0, 25))]
        state, got = whole.start, []
        for w in words:
            state, _, out = whole.arcs(state, w)
            got.append(sorted(out))
        want, tape = [[] for _ in words], words
        for m in toxicity.machines():  # each machine reads the whole tape that the one before it has left
            state, left = m.start, []
            for i, w in enumerate(tape):
                state, passed, out = m.arcs(state, w)
                left.append(passed)
                want[i] += out
            tape = left
        assert got == [sorted(x) for x in want]


def test_toxicity_factors_follow_labels():
    rng = np.random.default_rng(3)
    model = toxicity.ToxicityModel({"idiot": 4.0})
    y, totals = np.zeros(600), np.zeros((600, len(toxicity.EMITTED)))
    for i in range(600):  # plain insults are toxic, negated ones as well, reported ones never
        kind = i % 4
        if kind:
            totals[i, toxicity.PLACE[toxicity.INSULT | (0, 0, toxicity.NEGATED, toxicity.REPORTED)[kind]]] = 4.0
            y[i] = (kind != 3) ^ (rng.random() < 0.05)
    got = toxicity.fit_factors(model, totals, y)
    assert got.negated > model.negated and got.reported <= model.reported and got.near == model.near and got.threat == model.threat


def test_cues_count_copies_once(spark):
    rng = random.Random(21)
    rows = [(i, prose(rng, 40) + ". you grumkel " + prose(rng, 5), 1) for i in range(30)] + [(100 + i, prose(rng, 60) + rng.choice(["", " works"]), 0) for i in range(90)]
    rows += [(200 + i, f"one zorple copied. tail{i}", 1) for i in range(30)] + [(300 + i, prose(rng, 20) + " grumble", 1) for i in range(3)]
    cues = features.learn_cues(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
    assert any("grumkel".startswith(c.strip()) for c in cues) and not any(c.startswith("zor") for c in cues)
    find = features.CueFinder({"idi": 2.0, "oaf ": 3.0})
    assert find("Idiot oaf, oafish anidiot") == (5.0, 3.0) and features.CueFinder({})("x") == (0.0, 0.0)


def test_labelled_sample_is_bounded_in_rows(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(2000)] + [(i, "t") for i in range(20, 60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 3)] + [(i, i % 2) for i in range(20, 60)] + [(50, None), (51, 9)], "doc_id bigint, label int")
    got = features.labelled_sample(docs, labels, "label", 10, F.lit(True), (0, 1)).collect()
    assert len(got) <= 20 and {r.label for r in got} == {0, 1} and len({r.doc_id for r in got}) == len(got)


def test_toxicity_learns_stems_and_defined_cases(spark, odd):
    rng = random.Random(1)
    texts, labels = {}, []
    for i in range(600):
        bad = i % 4 == 0
        words = prose(rng, 60).split()
        if bad:
            words[rng.randrange(60)] = "grumk" + rng.choice(["a", "en", "isch", "ling"])
        texts[1000 + i] = " ".join(words)
        labels.append((1000 + i, 1, int(bad)))
    docs, lab = docs_of(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, lab, ~held_out(F.col("doc_id")))
    assert any(a.strip().startswith("gru") for a in model.arcs)
    truth = {i: t for i, _, t in labels}
    scored = toxicity.score(docs, model).collect()
    assert np.mean([(r.score >= 0.5) == truth[r.row.doc_id] for r in scored]) > 0.97
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    empty = toxicity.fit(docs, lab.limit(0), F.lit(True))
    assert empty.arcs == {} and toxicity.score(docs.limit(0), empty).count() == 0


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def vocab():
    return pieces.Vocabulary.of(pieces.read_model())


def samples():
    rng = random.Random(9)
    out = ["", " ", "a", "  two  spaces ", "Ａ▁b é\t\n\n x", "word " * 50, "ñandú über Straße", "日本語のテキスト", "x" * 300, "ab" * 200 + " tail", "\x00\x01", "🙂 ok"]
    return out + ["".join(rng.choice("abcdeéñ ,.\nTh") for _ in range(rng.randint(1, 200))) for _ in range(120)]


def test_tokens_equal_the_model_without_dropout(vocab):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t for t in samples() if "▁" not in t]
    tokens, sizes = pieces.encode_texts(vocab, texts, np.zeros(len(texts), dtype=np.uint64), 0.0)
    got = [x.tolist() for x in np.split(tokens, np.cumsum(sizes)[:-1])]
    assert got == [sp.encode(t) for t in texts]


def test_dropout_heap_and_rounds_agree_and_vary(vocab):
    rng = random.Random(2)
    units = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    keys = np.array([xxhash.xxh64_intdigest(u) for u in units], dtype=np.uint64)
    ids = np.full((len(units), 64), -1, dtype=np.int32)
    for i, u in enumerate(units):
        ids[i, : len(u)] = vocab.symbols(u)
    plain = None
    for p in (0.0, 0.1, 0.5, 1.0):
        limit = min(int(p * 2.0**64), 2**64 - 1)
        tokens, sizes = pieces.merge_many(vocab, ids, keys, limit)
        fast = [x.tolist() for x in np.split(tokens, np.cumsum(sizes)[:-1])]
        assert fast == [pieces.merge_one(vocab, vocab.symbols(u), int(k), limit) for u, k in zip(units, keys)]
        plain = plain or fast
        assert (fast == plain) == (p == 0)
    assert all(len(f) == len(u) for f, u in zip(fast, units)), "every merge dropped"


def test_dropout_is_that_of_each_occurrence(vocab):
    rng = random.Random(31)
    texts = ["the same words of the same text, the same again\n" * 4, "", *("".join(rng.choice("abcdeéñ ,.\nTh日") for _ in range(rng.randint(1, 90))) for _ in range(40)), "y" * 200 + " the end"]
    keys = np.array([rng.getrandbits(64) for _ in texts], dtype=np.uint64)
    for p in (0.05, 0.3, 1.0):
        limit = min(int(p * 2.0**64), 2**64 - 1)
        tokens, sizes = pieces.encode_texts(vocab, texts, keys, p)
        got = [x.tolist() for x in np.split(tokens, np.cumsum(sizes)[:-1])]
        for text, key, ids in zip(texts, keys, got):
            want = []
            for i, u in enumerate(pieces.UNIT.findall(" " + text) if text else []):  # every occurrence by itself, with a heap
                own = pieces._mix(np.array([key], dtype=np.uint64) + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))[0]
                want += pieces.merge_one(vocab, vocab.symbols(u), int(own), limit)
            assert ids == want
    words = pieces.encode_texts(vocab, ["information " * 400], keys[:1], 0.1)[0]
    assert len(set(map(tuple, np.array_split(words, 400)))) > 8, "occurrences of one word are cut in more than a few ways"


def test_tokens_decode_losslessly(spark, odd):
    docs = docs_of(spark, {i: t for i, t in enumerate(samples() * 2)})
    for seed in (1, 2):
        back = pieces.decode(pieces.encode(docs, dropout=0.2, seed=seed)).collect()
        assert all(r.decoded == r.text for r in back)
    a, b = ({tuple(r.token_ids) for r in pieces.encode(docs, dropout=0.2, seed=s).collect()} for s in (1, 2))
    assert a != b and a == {tuple(r.token_ids) for r in pieces.encode(docs, dropout=0.2, seed=1).collect()}
    back = pieces.decode(pieces.encode(odd)).collect()
    assert len(back) == odd.count() and all(r.decoded == (r.text or "") for r in back)
    assert pieces.encode(odd.limit(0)).count() == 0
    clash = odd.withColumns({"_text": F.lit("a"), "_variant": F.lit(1), "token_ids": F.lit("z"), "decoded": F.lit(2), "row": F.lit(3), "new": F.lit(4), "key": F.lit(5), "a.b": F.lit(6)})
    back = pieces.decode(pieces.encode(clash))
    assert sorted(back.columns) == sorted(clash.columns) and all(r.decoded == (r.text or "") and (r["_text"], r.row, r.new, r.key, r["a.b"]) == ("a", 3, 4, 5, 6) for r in back.collect())
    twins = docs_of(spark, ["the information of the documents " * 20]).crossJoin(spark.range(2).withColumnRenamed("id", "copy"))
    assert pieces.encode(twins).select("token_ids").distinct().count() == 1 and pieces.encode(twins, key=("doc_id", "copy")).select("token_ids").distinct().count() == 2


# ---------------------------------------------------------------- quality classifier and features


def test_terms_count_layout():
    texts = [b"one two two three", b"", b" lead", b"### a|b ||", b"Tail "]
    x, words = features.terms(texts)
    assert words.tolist() == [4, 0, 1, 3, 1] and x.shape == (5, features.WIDTH)
    for i, t in enumerate(texts):
        alone, n = features.terms([t])
        assert np.array_equal(alone[0], x[i]) and n[0] == words[i]


def test_neighbour_votes_are_exact(spark, odd):
    rng = random.Random(4)
    texts = {i: prose(rng, 60) if i % 2 else " ".join(["spam###"] * rng.randint(5, 60)) for i in range(300)}
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 300)], "doc_id bigint, quality int, toxic int")
    model = quality_knn.fit(docs, labels, "quality", ~held_out(F.col("doc_id")), sample=60)
    got = {r.row.doc_id: r.score for r in quality_knn.score(docs, model).collect()}
    assert all((s >= 0.3) == (i % 2 == 1) for i, s in got.items())
    x, _ = features.terms([texts[7].encode()])
    cosine = model.project(x.copy())[0] @ model.vectors.T
    top = np.argsort(-cosine, kind="stable")[: model.k]
    w = np.exp(20 * (cosine[top].astype(float) - 1)) * model.weights[top]
    assert got[7] == pytest.approx((w * model.labels[top]).sum() / w.sum(), abs=1e-3)
    scored = quality_knn.score(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    none = quality_knn.fit(docs, labels.limit(0), "quality", F.lit(True))
    assert {r.score for r in quality_knn.score(odd, none).collect()} == {0.5}
    one = quality_knn.fit(docs, labels.filter("quality = 1"), "quality", F.lit(True))
    assert {round(r.score, 9) for r in quality_knn.score(odd, one).collect()} == {1.0}
    assert quality_knn.score(odd.limit(0), model).count() == 0


# ---------------------------------------------------------------- sharding


def spark_hash(key, *ints):
    h = xxhash.xxh64_intdigest(key.encode(), 42)
    for i in ints:
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), h)
    return h


def test_rendezvous_matches_brute_force_and_moves_little(spark, odd):
    docs = spark.range(4000).withColumnRenamed("id", "doc_id")
    k = sharding.record_key(F.col("doc_id"))
    weights = [1.0, 2.0, 0.0, 1.0]
    got = docs.select("doc_id", sharding.rendezvous(k, weights).alias("a"), sharding.rendezvous(k, [*weights, 1.0]).alias("b")).collect()
    for r in got[:300]:
        u = [((spark_hash(f"k{r.doc_id}", 7, i) >> 11) + 0.5) / 2**53 for i in range(4)]
        assert r.a == max((-w / np.log(x), -i) for i, (w, x) in enumerate(zip(weights, u)) if w)[1] * -1
    assert all(r.b in (r.a, 4) for r in got)
    share = np.bincount([r.a for r in got], minlength=4) / 4000
    assert abs(share - np.array([0.25, 0.5, 0, 0.25])).max() < 0.03
    placed = sharding.assign_shards(odd.select("doc_id", F.length("text").alias("size")), "doc_id", [1.0] * 3, ["size"], buckets=4).collect()
    slots = {}
    for r in placed:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(placed) == odd.count() and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(odd.limit(0), "doc_id", [1.0], ["text"]).count() == 0
    clash = odd.withColumns({c: F.lit(c) for c in ("_n", "_bucket", "_before", "bucket", "n", "before", "row", "shard", "slot", "a.b")})
    out = sharding.assign_shards(clash, "doc_id", [1.0] * 3, ["text"])
    assert sorted(out.columns) == sorted(clash.columns) and out.count() == odd.count()
    assert all(r["_n"] == "_n" and r["bucket"] == "bucket" and r["a.b"] == "a.b" and r.shard in (0, 1, 2) for r in out.collect())


# ---------------------------------------------------------------- quality rules


def counts(text):
    words, lines = WORDS.findall(text), [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


def test_quality_rules_match_brute_force(spark, odd):
    rng = random.Random(8)
    texts = [prose(rng, rng.randint(0, 120)) for _ in range(60)] + ["a b c d e a b c d e", "a a a a a a a", "a b c d e f", "x\ny\nx\n\n x\nx", "#*$%&|<>", "a b c", "a\x0bb\x0cc"] + ["the cat sat on the mat and " * 20]
    got = quality_rules.apply_rules(docs_of(spark, texts)).collect()
    for r in got:
        q, want = r.quality, counts(r.text)
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want, r.text
        assert q.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (q.base_failed and q.kept)
    out = quality_rules.apply_rules(odd)
    assert out.count() == odd.count() and all(r.quality.base_failed for r in out.filter("text is null or trim(text) = ''").collect())
    assert quality_rules.apply_rules(odd.limit(0)).count() == 0
    clash = odd.withColumns({c: F.lit(c) for c in ("_counts", "counts", "row", "quality", "a.b")})
    judged = quality_rules.apply_rules(clash)
    assert sorted(judged.columns) == sorted(clash.columns) and all(r["_counts"] == "_counts" and r.counts == "counts" and r.quality.n_words >= 0 for r in judged.collect())


# ---------------------------------------------------------------- simhash


def brute_print(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_golay_keys_meet_within_one_bit():
    code = simhash.Golay.tables()
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 4000)
    own, keys = code.keys(x)
    weights = np.bitwise_count(x ^ code.words[own])
    assert weights.max() == 3 and set(np.unique((keys >= 0).sum(axis=1))) == {1, 6}
    assert all(np.bitwise_count(int(a) ^ int(code.words[k])) <= 4 for a, ks in zip(x[:500], keys[:500]) for k in ks if k >= 0)
    near, _ = code.keys(x ^ (1 << rng.integers(0, 22, 4000)))
    assert (keys == near[:, None]).any(axis=1).all()


def test_links_find_every_near_pair(spark):
    rng = random.Random(6)
    prints = {0, 2**64 - 1}
    for _ in range(60):
        f = rng.getrandbits(64)
        prints.add(f)
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 5)):
                g ^= 1 << b
            prints.add(g)
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    want = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    assert {(r.u, r.v) for r in simhash.links(df).collect()} == want and len(want) > 100
    seen = {r.node: r.root for r in components.components(simhash.links(df)).collect()}
    group = {p: p for p in prints}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in want:
        x, y = sorted((top(a), top(b)))
        group[y] = x
    assert seen == {p: top(p) for e in want for p in e}


def test_simhash_query_matches_brute_force(spark, odd):
    rng = random.Random(7)
    base = [prose(rng, 150).split(" ") for _ in range(6)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(5):
            c = list(b)
            c[rng.randrange(len(c))] = "swap"
            texts.append(" ".join(c))
    texts += ["", None, "one", "one two", "ONE TWO", "one  two three", "É x y z"]
    got = simhash.near_duplicates(docs_of(spark, texts)).collect()
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.fingerprint & (2**64 - 1) for r in got} == prints
    root = {i: i for i in prints}
    for _ in prints:
        root = {i: min(root[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
    assert {r.doc_id: r.component_id for r in got} == root
    more = simhash.near_duplicates(odd).collect()
    assert len(more) == odd.count() and {r.component_id for r in more if r.doc_id in (1, 2, 3, None)} >= {1}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_near_copies_keep_one_of_each_component(spark, odd):
    import corpus_pipeline

    rng = random.Random(8)
    more = spark.createDataFrame([(None, prose(rng, 60 + i), "a", "b", 1, 0.5, True, "z") for i in range(5)], odd.schema)
    for docs in (odd, odd.union(more)):
        rows = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
        root = {p: p for _, p in rows}
        for _ in rows:
            root = {p: min(root[q] for q in root if (p ^ q).bit_count() <= 3) for p in root}
        want = []
        for top in set(root.values()):
            least = min((i is None, i or 0, p - 2**64 if p >= 2**63 else p) for i, p in rows if root[p] == top)
            want.append((None if least[0] else least[1], least[2] & (2**64 - 1)))
        for kept in (simhash.keep_one(docs), corpus_pipeline.drop_near_copies(spark, docs, "")):
            assert kept.columns == docs.columns
            assert sorted((str(r.doc_id), brute_print(r.text)) for r in kept.collect()) == sorted((str(i), p) for i, p in want)
    assert simhash.keep_one(odd.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(300, 299), (5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}, 299: 299, 300: 299}


# ---------------------------------------------------------------- exact dedup


def test_lowering_touches_ascii_only(spark):
    texts = ["ABC xyz", "ÀÉ ABC", "ẞ I İ", "", "Z" * 10]
    got = docs_of(spark, texts).select("text", ascii_lower(F.col("text")).alias("low")).collect()
    assert all(r.low == "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text) for r in got)


def test_exact_dedup_and_its_index(spark, odd):
    texts = ["Same", "same", "SAME", None, "", "ÉCOLE", "école", "solo"]
    got = {r.doc_id: r for r in exact_index.dedup_exact(docs_of(spark, texts)).collect()}
    assert [got[i].keep_id for i in range(8)] == [2, 2, 2, 4, 4, 5, 6, 7] and [got[i].group_size for i in range(8)] == [3, 3, 3, 2, 2, 1, 1, 1]
    assert [i for i in range(8) if got[i].kept] == [2, 4, 5, 6, 7]
    assert got[1].digest == bytearray(hashlib.sha256(b"same").digest())
    out = exact_index.dedup_exact(odd).collect()
    assert len(out) == odd.count() and sum(r.kept for r in out) == len({bytes(r.digest) for r in out})
    assert exact_index.dedup_exact(odd.limit(0)).count() == 0
    index = exact_index.DigestIndex.fresh(spark)
    first = exact_index.dedup_exact(docs_of(spark, {10: "old", 11: "Old"}), index).collect()
    again = {r.doc_id: r for r in exact_index.dedup_exact(docs_of(spark, {20: "OLD", 21: "new"}), index).collect()}
    assert {r.keep_id for r in first} == {11} and not again[20].kept and again[20].keep_id == 11 and again[21].kept
    assert index.read().count() == 2
    same_name = exact_index.DigestIndex(spark, index.name)
    third = {r.doc_id: r for r in exact_index.dedup_exact(docs_of(spark, {30: "NEW", 31: "third"}), same_name).collect()}
    assert not third[30].kept and third[30].keep_id == 21 and third[31].kept and same_name.read().count() == 3
    lost = docs_of(spark, {40: "half", 41: "written"}).select("doc_id", exact_index.text_digest(F.col("text")).alias("digest"))
    same_name.append(lost, "a driver lost before its commit")
    assert same_name.read().count() == 3 and all(r.kept for r in exact_index.dedup_exact(docs_of(spark, {42: "half"}), same_name).collect())
    assert [r.doc_id for r in exact_index.keep_one(docs_of(spark, {50: "old", 51: "fresh"}), same_name).collect()] == [51]
    index.drop()
    left = {t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")}
    exact_index.dedup_exact(docs_of(spark, ["a"])).count(), exact_index.keep_one(docs_of(spark, ["a"])).count()
    assert {t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")} == left


# ---------------------------------------------------------------- mixing


def test_rates_reach_targets(spark, odd):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.2, 0.2, 0.2], 500)
    n = rng.integers(1, 500, 500)
    members = spark.createDataFrame([((i,), int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(n, p))], "row struct<doc_id: bigint>, n_tokens bigint, posterior array<double>")
    for share in ([0.5, 0.3, 0.2], [0.85, 0.1, 0.05], [1 / 3, 1 / 3, 1 / 3]):
        fitted = mixing.fit_rates(members, share)
        got = members.select("row.doc_id", fitted.rate.alias("r")).collect()
        r = np.array([x.r for x in sorted(got)])
        assert (r >= 0).all() and np.allclose((r * n) @ p / n.sum(), share, atol=1e-5) and np.allclose((r * n) @ p, fitted.expected, rtol=1e-6) and fitted.residual < 1e-5
        best = nearest_rates(n, p, np.array(share) * n.sum())
        assert np.allclose(r, best, atol=1e-3), "of all rates that reach the targets, the nearest to 1"
    zero = mixing.fit_rates(members.withColumn("n_tokens", F.lit(0).cast("bigint")), [0.5, 0.3, 0.2])
    assert members.select(zero.rate.alias("r")).distinct().collect()[0].r == 1.0
    with pytest.warns(UserWarning, match="stays"):
        short = mixing.fit_rates(members.withColumn("posterior", F.array(F.lit(0.9), F.lit(0.1), F.lit(0.0))), [0.5, 0.3, 0.2])
    assert short.residual > 0.1 and np.isfinite(short.slope).all()


def nearest_rates(n, p, goal):
    """By alternating projections (Dykstra) onto the totals and the rates of 0 or more, in the norm weighted by tokens."""
    a = p * n[:, None]
    pull = p @ np.linalg.inv(p.T @ a)
    r, q = np.ones(len(n)), np.zeros(len(n))
    for _ in range(20000):
        r = r + pull @ (goal - a.T @ r)
        y = np.maximum(r + q, 0)
        r, q = y, r + q - y
    return r


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_mix_reaches_targets_on_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = mixing.mix(docs, mixing.label_domains(labels), keep=["doc_id"]).collect()
    n, r, p = np.array([x.n_tokens for x in got]), np.array([x.rate for x in got]), np.array([x.posterior for x in got])
    assert np.allclose((n * r) @ p / n.sum(), list(mixing.TARGETS.values()), atol=1e-4) and got[0].residual < 1e-4
    assert [x.n_tokens for x in sorted(got, key=lambda x: x.row.doc_id)] == [len(WORDS.findall(x.text or "")) for x in docs.orderBy("doc_id").collect()]
    domain = {x.doc_id: x.domain for x in mixing.label_domains(labels).collect()}
    assert np.mean([int(np.argmax(x.posterior)) == domain[x.row.doc_id] for x in got if x.row.doc_id in domain]) > 0.95


def test_mix_defined_cases(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (8, 1, 1)], "doc_id bigint, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        got = mixing.mix(odd, mixing.label_domains(lab)).collect()
        assert len(got) == odd.count() and all(r.rate >= 0 and int(r.rate) <= r.copies <= int(r.rate) + 1 and abs(sum(r.posterior) - 1) < 1e-6 for r in got)
    assert mixing.mix(odd.limit(0), mixing.label_domains(labels)).count() == 0


# ---------------------------------------------------------------- suffix arrays


def brute_cut(texts):
    seen, out = set(), {}
    for i, t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        out.setdefault(i, []).append((len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), bytes(c for c, g in zip(raw, gone) if not g)))
    return out


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(3)
    for text in (rng.integers(97, 100, 3000), np.full(500, 97), np.tile(rng.integers(97, 123, 130), 6), np.zeros(0)):
        text = text.astype(np.uint8)
        sa, _ = suffix_dedup.suffix_array(text) if len(text) else (np.zeros(0, int), None)
        raw = text.tobytes()
        cut = [raw[i : i + 100] for i in sa]
        assert cut == sorted(cut) and sorted(sa.tolist()) == list(range(len(raw)))
        if len(text):
            lcp = suffix_dedup.common_prefixes(text, sa)
            for k in range(1, len(sa)):
                a, b = raw[sa[k - 1] :], raw[sa[k] :]
                n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
                assert lcp[k] == min(n, 100)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(40) for _ in range(5)]
    texts = [text(rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 80) :] + text(rng.randint(0, 30)) + rng.choice([*shared, ""]) for _ in range(60)]
    texts += [texts[3], texts[3] + "x", "a" * 400, "ab" * 300, "a" * 99, "a" * 100, "", None, "é" * 120]
    return list(enumerate(texts))


@pytest.mark.parametrize("shard_bytes", [2 << 20, 600])
def test_suffix_dedup_matches_brute_force(spark, odd, monkeypatch, shard_bytes):
    texts = passages(shard_bytes)
    want = brute_cut(texts)
    if shard_bytes == 600:  # shards so small that anchors outgrow them; in this process, as tasks don't see the patch
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
        marks = in_process(texts)
        import pyarrow as pa

        rows = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t or "", "marks": marks.get(i)} for i, t in texts], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("marks", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))]))
        got = [r for b in suffix_dedup._cut_rows(iter([rows])) for r in b.to_pylist()]
        assert {r["doc_id"]: [(r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), r["kept"])] for r in got} == want
        return
    got = suffix_dedup.remove_repeats(docs_of(spark, dict(texts))).collect()
    assert {r.doc_id: [(r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept))] for r in got} == want
    assert suffix_dedup.remove_repeats(odd).count() == odd.count()
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0


def in_process(texts):
    import pyarrow as pa

    rows = pa.RecordBatch.from_pylist([{"rid": i, "text": t or ""} for i, t in texts], schema=pa.schema([("rid", pa.int64()), ("text", pa.string())]))
    found = [r for b in suffix_dedup._anchor_rows(iter([rows])) for r in b.to_pylist()]
    kind = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("hashes", pa.list_(pa.int64())), ("spots", pa.list_(pa.int64()))])
    cut = []
    for at in range(0, len(texts), 7):  # seven documents a shard
        block = []
        for i, t in texts[at : at + 7]:
            mine = [r for r in found if r["rid"] == i]
            block.append({"rid": i, "doc_id": i, "text": t or "", "hashes": [r["hash"] for r in mine], "spots": [r["spot"] for r in mine]})
        cut += [{**r, "shard": r["shard"] and r["shard"] + at} for b in suffix_dedup._stretch_rows(iter([pa.RecordBatch.from_pylist(block, schema=kind)])) for r in b.to_pylist()]
    cut.sort(key=lambda r: r["hash"])
    marks = {}
    batches = [pa.RecordBatch.from_pylist(cut[i : i + 50], schema=suffix_dedup._STRETCH) for i in range(0, len(cut), 50)]
    for b in suffix_dedup._repeat_rows(iter(batches)):
        for r in b.to_pylist():
            marks.setdefault(r["rid"], []).append({"first": r["first"], "last": r["last"]})
    return marks


def test_runs_merge_to_the_first_of_equal_stretches():
    rng = np.random.default_rng(8)
    for rows in (1, 2, 40, 700):
        n = rng.integers(1, 4, rows)
        body = [np.concatenate([rng.integers(0, 2, 2), np.zeros(k + suffix_dedup.LENGTH - 3)]).astype(np.uint8) for k in n]
        s = suffix_dedup.Stretches(rng.integers(-2, 2, rows), rng.integers(0, 20, rows), rng.integers(0, 9, rows), rng.permutation(rows), rng.integers(0, 5, rows), n, np.concatenate(body))
        first = {}
        for i in range(rows):
            key = (s.hash[i], body[i].tobytes())
            if key not in first or (s.doc[i], s.rid[i], s.start[i]) < (s.doc[first[key]], s.rid[first[key]], s.start[first[key]]):
                first[key] = i
        assert sorted(suffix_dedup.merge_runs(s).tolist()) == sorted(first.values())


def test_long_text_goes_piece_by_piece(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    texts = passages(11)
    assert {i: sorted((m["first"], m["last"]) for m in v) for i, v in in_process(texts).items()}.keys() <= dict(texts).keys()
    want = {i: v[0][1] for i, v in brute_cut(texts).items()}
    for i, v in in_process(texts).items():
        assert len({p for m in v for p in range(m["first"], m["last"] + 100)}) == want[i]


def test_very_long_text_through_every_operator(spark):
    """One text of 5 MB, beside short ones that share a passage with it."""
    rng = random.Random(77)
    line = [" ".join(rng.choice("alpha beta gamma delta omega the of and in".split()) + str(rng.randint(0, 99999)) for _ in range(12)) for _ in range(60_000)]
    long = "\n".join(line)
    assert len(long) > 5_000_000
    docs = docs_of(spark, {1: long, 2: line[500] + " " + line[900], 3: "short text"}).coalesce(1)
    back = pieces.decode(pieces.encode(docs)).collect()
    assert all(r.decoded == r.text for r in back)
    cut = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    again = brute_cut([(1, long), (2, line[500] + " " + line[900])])
    assert cut[1].n_bytes - len(cut[1].kept) == again[1][0][1] and bytes(cut[2].kept) == again[2][0][3]
    prints = {r.doc_id: r.fingerprint & (2**64 - 1) for r in simhash.near_duplicates(docs).collect()}
    assert prints[1] == brute_print(long)
    kept = {r.doc_id: r for r in exact_index.dedup_exact(docs).collect()}
    assert kept[1].digest == bytearray(hashlib.sha256(long.lower().encode()).digest())
    judged = {r.doc_id: r.quality for r in quality_rules.apply_rules(docs).collect()}
    assert judged[1].n_words == 60_000 * 12 and judged[1].n_dup_lines == len(line) - len(set(line))
    model = toxicity.ToxicityModel({"gamma77777": 5.0})
    assert {r.row.doc_id: round(r.score, 9) for r in toxicity.score(docs, model).collect()} == {i: round(model.score(t), 9) for i, t in ((1, long), (2, line[500] + " " + line[900]), (3, "short text"))}
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_knn.score(docs, quality_knn.fit(docs, labels, "quality", F.lit(True))).count() == 3
    assert {r.row.doc_id: r.n_tokens for r in mixing.mix(docs, mixing.label_domains(labels)).collect()} == {1: 720_000, 2: 24, 3: 2}
    placed = sharding.assign_shards(docs.select("doc_id", F.crc32(F.col("text").cast("binary")).alias("text_crc32")), "doc_id", [1.0] * 4, ["text_crc32"]).collect()
    assert len(placed) == 3
    turns = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id bigint, turn bigint, role string, text string")
    said = chat.format_chats(turns).withColumn("t", chat.parse_chat(F.col("formatted"))).collect()[0]
    assert [x.text for x in said.t] == [long, long]


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from obskit.llm import common

    class Conf:
        def __init__(self, named):
            self.named = named

        def get(self, name, default=None):
            return self.named.get(name, default)

    class Session:
        def __init__(self, **named):
            self.conf = Conf({k.replace("_", "."): v for k, v in named.items()})

    assert common.shared_dir(Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///x/")) == "hdfs:///x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session(spark_master="spark://host:7077"))
    kept = common.durable(spark.range(3))
    assert kept.count() == 3 and os.path.isdir(kept.durable_path)
    common.forget(kept)
    assert not os.path.isdir(kept.durable_path)


def test_hot_groups_join_like_the_others(spark):
    from obskit.llm.common import join_groups

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "i int, k string")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "n")
    want = {(r.i, r.k, r.n) for r in rows.join(groups, "k").collect()}
    for parts in (1, 3, 1000):  # no group is frequent, one is, all are
        got = join_groups(rows, groups, "k", "n", parts).select("i", "k", "n").collect()
        assert len(got) == 60 and {tuple(r) for r in got} == want
    assert join_groups(rows.limit(0), groups.limit(0), "k", "n").count() == 0
