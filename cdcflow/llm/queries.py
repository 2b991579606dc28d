"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.llm.store import ship


#: Shares of all words per labelled domain that op4 mixes to.
MIX_WEIGHTS = {"good": 0.92, "low": 0.06, "toxic": 0.02}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.substring import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.packing import pack

    return pack(table(spark, sf_dir, "documents")).drop("ids")


def op4_mix_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.mixing import by_weight, mix

    labels = table(spark, sf_dir, "labels")
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    out = mix(table(spark, sf_dir, "documents"), labels.select("doc_id", domain.alias("domain")), by_weight(MIX_WEIGHTS))
    return out.select("doc_id", "n_tokens", F.map_from_arrays("domains", "posterior").alias("p"), "rate", "copies").select(
        "doc_id", "n_tokens", *[F.col("p").getItem(d).alias(f"p_{d}") for d in sorted(MIX_WEIGHTS)], "rate", "copies")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.secret_scan import fit, scan

    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.pii import fit, scan

    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs)).drop("redacted")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.jaccard import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.quality import SIGNALS, judge

    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *SIGNALS, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.langid import fit, identify

    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return identify(docs, fit(docs, ~held_out), F.col("doc_id"), held_out.alias("held_out"))


#: A conversation whose texts are made of the template's own strings.
PROBE = "VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm import chat

    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.unionByName(spark.sql(f"SELECT * FROM {PROBE}"))
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    made = chat.conversations(chat.chain(rows, tree, [F.col("turn"), F.col("role"), F.col("text")]))
    read = made.select(F.expr("try_cast(tree AS BIGINT)").alias("conv_id"), "formatted", "loss", chat.turns(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (read.withColumn("learnt", chat.learnt(F.col("formatted"), F.col("loss")))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.resample import resample

    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.merkle import manifest

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return manifest(table(spark, sf_dir, "documents"), F.when(tampered, bare).otherwise(F.col("text")))


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.llm.rulefit import fit, score

    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    out = score(docs, fit(docs, labels), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return out.select("doc_id", "held_out", "score", "predicted")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op4_mix_to_target_weights": op4_mix_to_target_weights,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op5_secret_scan": op5_secret_scan,
    "op6_pii": op6_pii,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_target_resampling": op11_target_resampling,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_rule_ensemble": op13_rule_ensemble,
}


#: CRC-32 by half bytes, the low one first (fixed values of its reflected polynomial).
_CRC = "[" + ", ".join(str(v) for v in (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C)) + "]"


def crc32_sql(text: str) -> str:
    """DuckDB: the unsigned CRC-32 of a text's UTF-8 bytes."""
    half = f"list_transform(range(2 * strlen({text})), lambda j: CAST(strpos('0123456789ABCDEF', substr(hex(encode({text})), xor(j, 1) + 1, 1)) - 1 AS BIGINT))"
    return f"xor(list_reduce({half}, lambda c, v: xor(c >> 4, CAST({_CRC}[xor(c & 15, v) + 1] AS BIGINT)), CAST(4294967295 AS BIGINT)), 4294967295)"


def _field(name: str, expr: str | None = None) -> str:
    text = f"CAST({expr or name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _words_sql(text: str) -> str:
    return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE: dict[str, str] = {
    "op2_exact_top_k": """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok q JOIN ok d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
""",
    "op10_chat_formatting": """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^<\\[\\\\]', '', 'g')) AS escaped FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
         sum(escaped + length('<s>') + length('[/INST]') + length('</s>')) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars,
       sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
""",
    "op11_target_resampling": f"""
WITH w AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, {_words_sql("coalesce(text, '')")} FROM benchmark),
f AS (
  SELECT kind, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM w),
x AS (SELECT f, {crc32_sql("f")} % 10000 AS b FROM (SELECT DISTINCT f FROM f)),
n AS (SELECT kind, r, b, count(*) AS n FROM f JOIN x USING (f) GROUP BY ALL),
g AS (
  SELECT b, sum(n) FILTER (WHERE kind = 'd') AS s, sum(n) FILTER (WHERE kind = 'b') AS t FROM n GROUP BY b),
a AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM g),
gain AS (
  SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
         / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM g, a),
p AS (SELECT r, sum(n) AS n_features, sum(n * gain) AS weight FROM n JOIN gain USING (b) WHERE kind = 'd' GROUP BY r),
h AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN p USING (r) WHERE kind = 'd'),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM h),
o AS (
  SELECT *, n_words >= 20 AS may, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) AS k,
         count(*) OVER (PARTITION BY n_words >= 20) AS of FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND k <= 5 * of // 100 THEN k END AS rank FROM o
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE l AS (
  SELECT doc_id, source, sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS h,
         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0
              THEN sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {_field("text", "replace(text, chr(10), '')")}) END AS bad
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS k, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s FROM l),
up AS (
  SELECT 0 AS level, s, k, h, count(*) OVER (PARTITION BY s) AS of FROM leaves
  UNION ALL
  SELECT level + 1, s, k // 3, sha256(string_agg(h, '' ORDER BY k)), (any_value(of) + 2) // 3 FROM up WHERE of > 1 GROUP BY level, s, k // 3),
top AS (
  SELECT 0 AS level, s - 1 AS k, h, count(*) OVER () AS of FROM up WHERE of = 1
  UNION ALL
  SELECT level + 1, k // 3, sha256(string_agg(h, '' ORDER BY k)), (any_value(of) + 2) // 3 FROM top WHERE of > 1 GROUP BY level, k // 3),
way AS (
  SELECT d.s, d.k, u.level AS level, string_agg(u.h, '' ORDER BY u.k) FILTER (WHERE u.k < d.k // CAST(pow(3, u.level) AS BIGINT)) AS lefts,
         string_agg(u.h, '' ORDER BY u.k) FILTER (WHERE u.k > d.k // CAST(pow(3, u.level) AS BIGINT)) AS rights
  FROM leaves d JOIN up u ON u.s = d.s AND u.of > 1 AND u.k // 3 = d.k // CAST(pow(3, u.level + 1) AS BIGINT) GROUP BY ALL
  UNION ALL
  SELECT d.s, d.k, 100 + u.level, string_agg(u.h, '' ORDER BY u.k) FILTER (WHERE u.k < (d.s - 1) // CAST(pow(3, u.level) AS BIGINT)),
         string_agg(u.h, '' ORDER BY u.k) FILTER (WHERE u.k > (d.s - 1) // CAST(pow(3, u.level) AS BIGINT))
  FROM leaves d JOIN top u ON u.of > 1 AND u.k // 3 = (d.s - 1) // CAST(pow(3, u.level + 1) AS BIGINT) GROUP BY ALL),
steps AS (SELECT s, k, row_number() OVER (PARTITION BY s, k ORDER BY level) AS step, coalesce(lefts, '') AS lefts, coalesce(rights, '') AS rights FROM way),
fold AS (
  SELECT s, k, 0 AS step, coalesce(bad, h) AS node FROM leaves
  UNION ALL
  SELECT fold.s, fold.k, fold.step + 1, sha256(lefts || node || rights) FROM fold JOIN steps ON steps.s = fold.s AND steps.k = fold.k AND steps.step = fold.step + 1),
folded AS (SELECT s, k, max_by(node, step) AS node FROM fold GROUP BY s, k),
proof AS (SELECT s, k, string_agg(lefts || rights, '' ORDER BY step) AS p FROM steps GROUP BY s, k),
root AS (SELECT h AS root FROM top WHERE of = 1)
SELECT doc_id, leaves.h AS leaf, up.h AS subroot, root, sha256(coalesce(p, '')) AS proof_sha256, node AS folded_root, node = root AS verified
FROM leaves JOIN up ON up.s = leaves.s AND up.of = 1 JOIN folded ON folded.s = leaves.s AND folded.k = leaves.k
LEFT JOIN proof ON proof.s = leaves.s AND proof.k = leaves.k, root
""",
}
