"""The registered queries of the training-data operators, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, exact_index, gnat, mixing, pieces, quality_knn, quality_rules, sharding, simhash, suffix_dedup, toxicity, vantage
from .common import held_out, table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    out = chat.format_chats(turns.unionByName(extra)).withColumn("turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    said_of = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(said_of, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, ~held_out(F.col("doc_id")))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("matches").alias("n_clauses"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = pieces.decode(pieces.encode(docs))
    return back.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.xxhash64("token_ids").alias("tokens_xxh64"), F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_knn.fit(docs, labels, "quality", ~held_out(F.col("doc_id")))
    scored = quality_knn.score(docs, model, ["doc_id"])
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign_shards(rows, "doc_id", [1.0] * 40, ["size", "text_crc32"])
    grown = sharding.rendezvous(sharding.record_key(F.col("doc_id")), [1.0] * 41)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), grown.alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col("quality")
    return judged.select("doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_index.dedup_exact(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mixed = mixing.mix(docs, mixing.label_domains(labels), keep=["doc_id"])
    return mixed.select("row.doc_id", "n_tokens", *[F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)], "rate", "copies", "residual")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vantage.cluster(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    return found.select("row.vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return gnat.mine(rows, F.col("id") % 100 == 0)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "token_ids")
    back = byte_bpe.decode(tokens)
    return back.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict:
    own = (op1_chat_formatting, op2_toxicity, op3_sentencepiece, op4_quality_classifier, op5_sharding, op6_quality_rules, op7_simhash, op8_exact_dedup, op9_mixing, op10_suffix_dedup, op11_centroid_clustering, op12_hard_negatives, op13_byte_bpe)
    return {f.__name__: f for f in own}


_CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed as (
  select *, row_number() over w as n, lag(role) over w as before,
    length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?SYS\]|SEP\]|/?s>|ROLE=[0-9A-F]*\]|/ROLE\])', '\1\\\2\3', 'g')) as escaped,
    case role when 'user' then 15 when 'system' then 13 when 'assistant' then 9 else 16 + 2 * strlen(role) end as marks
  from turns window w as (partition by conv_id order by turn nulls last, role, text))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(escaped + case when n > 1 and before = role then 5 else marks end) as bigint) as formatted_chars
from placed group by conv_id
"""

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
_RULES = rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (select r, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
windows as (select r, i, array_to_string(w[i:i + 4], ' ') as g from (select r, w, unnest(generate_series(1, len(w) - 4)) as i from words where len(w) >= 5)),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (select r, count(distinct i + k) as n from again, generate_series(0, 4) as s(k) group by r),
c as (select doc_id, len(w) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
  len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(list_filter(w, lambda x: lower(x) in ({_STOPS}))) as n_stop
  from words left join covered using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, cast(n_dup_lines as bigint) as n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars / n_words between 2.0 and 14.0 and n_symbols / n_words <= 0.25 and n_stop / n_words >= 0.01
    and case when n_lines > 0 then n_dup_lines / n_lines else 0 end <= 0.5 as kept
from b
"""

_EXACT = """
with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id and row_number() over (partition by text_sha256, doc_id) = 1 as kept, text_sha256
from t join g using (text_sha256)
"""

_WHOLE = "list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint))"
_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """Lloyd rounds written out, one after the other."""
    steps = [
        f"kept as materialized (select row_number() over () as r, vec_id, {_WHOLE} as v from embeddings where {_FINITE} and len(embedding) = 64)",
        f"c0 as materialized (select row_number() over (order by sha256('2:' || vec_id), v) - 1 as c, v from kept order by c limit {k})",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} as materialized (select r, any_value(vec_id) as vec_id, any_value(v) as v, min(struct_pack(d := d, c := c)) as best from ("
            f"select r, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) as d from kept, c{i}) group by r)"
        )
        if i < rounds:
            steps.append(f"m{i} as materialized (select c, list(x order by i) as v from (select c, i, cast(floor(sum(x) / count(*)) as bigint) as x from (select best.c as c, unnest(v) as x, unnest(range(64)) as i from a{i}) group by c, i) group by c)")
            steps.append(f"c{i + 1} as materialized (select c, coalesce(m{i}.v, c{i}.v) as v from c{i} left join m{i} using (c))")
    return (
        f"with {', '.join(steps)} select vec_id, cast(best.c as int) as cluster, cast(best.d as bigint) as distance, cast(sum(best.d) over (partition by best.c) as bigint) as cluster_inertia, "
        f"cast(sum(best.d) over () as bigint) as inertia, sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256 from a{rounds} join c{rounds} on best.c = c"
    )

_NEGATIVES = f"""
with e as materialized (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, {_WHOLE} as v from embeddings where label is not null and {_FINITE}),
scored as materialized (select a.r as a, a.vec_id as anchor_id, b.r as b, b.vec_id, a.label = b.label as alike, cast(list_inner_product(a.v::double[], b.v::double[]) as bigint) as score
  from e a, e b where a.vec_id % 100 = 0 and a.r <> b.r),
positives as (select a, anchor_id, b, vec_id as positive_id, score as positive_score, row_number() over (partition by a order by score desc, vec_id) as p from scored where alike),
found as (select anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
  row_number() over (partition by a, p order by score desc, vec_id) as rank
  from positives join (select a, vec_id, score from scored where not alike) n using (a) where p <= 5 and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from found where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": _CHAT, "op6_quality_rules": _RULES, "op8_exact_dedup": _EXACT, "op11_centroid_clustering": _clusters(), "op12_hard_negatives": _NEGATIVES}
