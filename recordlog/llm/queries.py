"""The registered queries of the subpackage: ``opN_<name>`` applies operator N to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlog.llm import divergence, embeddings, fingerprints, language_model, lines, mixing, packing, personal, quality, simhash, substrings, toxicity, trie


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def tokenizer_path() -> str:
    """The public vocabulary that packing counts tokens with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(sized, size_col="size").select("doc_id", "size", "source_size", "target", "taken",
                                                     "finish_time", "copies")


def op2_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find(_table(spark, sf_dir, "documents", "doc_id", "text"))
    counts = [personal.count_of(F.col("base"), k).alias(f"n_{k}") for k in personal.KINDS]
    every = F.array_sort(F.concat("base", "added"))
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(personal.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        personal.as_text(every).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.classify(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic")).withColumnRenamed("id", "doc_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = quality.classify(docs, _table(spark, sf_dir, "labels", "doc_id", "quality"))
    return found.withColumnRenamed("id", "doc_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.judged(_table(spark, sf_dir, "documents", "doc_id", "text"), short=True)
    return found.select(F.col("id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.links(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path()).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc32").alias("ids_crc32"), "sequence_id", "offset")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
                        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
                        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return trie.trie(trie.rebuilt(trie.sequences(turns)))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents", "text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_personal, op3_substrings, op4_toxicity, op5_quality, op6_simhash, op7_lines, op8_embeddings, op9_packing, op10_fingerprints,
                              op11_language_model, op12_prefix_trie, op13_divergence)
}
#: DuckDB has no XXH64 with a seed, tokenizer, network or boosting: the other operators are held
#: against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op3_substrings": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS s,
                  unnest([sha256(array_to_string(ws[s:s + 19], ' ')) for s in range(1, len(ws) - 18)]) AS t FROM w),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS nth FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE nth > 1),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - COALESCE(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op12_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text}
                       ORDER BY turn NULLS FIRST, role, sha256(concat(length(role), ':', role, text))[1:32]) AS ts
  FROM turns GROUP BY conv_id),
h AS (
  SELECT conv_id, ts, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
    CAST(4294967295 AS BIGINT)) % 4 AS INTEGER) AS h
  FROM own),
convs AS (
  SELECT a.conv_id, list_concat(COALESCE(list_slice(b.ts, 1, a.h), []), list_slice(a.ts, a.h + 1, len(a.ts))) AS ts
  FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
prefixes AS (SELECT conv_id, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS depth, ts FROM convs),
keyed AS (SELECT conv_id, n, depth, ts, sha256(CAST(to_json(list_slice(ts, 1, depth)) AS VARCHAR)) AS k,
                 CASE WHEN depth > 0 THEN sha256(CAST(to_json(list_slice(ts, 1, depth - 1)) AS VARCHAR)) END AS pk FROM prefixes),
nodes AS (
  SELECT k, any_value(pk) AS pk, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN any_value(depth) > 0 THEN (count(*) - 1) * len(regexp_extract_all(any_value(ts[depth].text), '[^\x20\x09-\x0D]+')) ELSE 0 END AS v,
         sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends
  FROM keyed GROUP BY k),
children AS (SELECT pk AS k, count(*) AS c FROM nodes WHERE pk IS NOT NULL GROUP BY pk),
-- each node with its ancestors and itself, by the prefixes of its smallest member
above AS (
  SELECT a.k, nodes.v, CASE WHEN children.c IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes LEFT JOIN children USING (k) JOIN keyed a ON a.conv_id = nodes.conv_id AND a.depth <= nodes.depth),
sums AS (SELECT k, sum(v) AS saved, sum(leaf) AS leaves FROM above GROUP BY k)
SELECT nodes.conv_id, nodes.depth, p.conv_id AS parent_conv_id, nodes.n_convs, COALESCE(children.c, 0) AS n_children,
       CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes LEFT JOIN nodes p ON p.k = nodes.pk LEFT JOIN children ON children.k = nodes.k JOIN sums ON sums.k = nodes.k""",
    "op13_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS i, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
words AS (SELECT i, lang, source, unnest(ts) AS t FROM d),
kept AS (SELECT lang, t FROM words GROUP BY lang, t HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, t, count(*) AS c FROM words JOIN kept USING (lang, t) GROUP BY lang, source, t),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, COALESCE(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT lang, source, t, COALESCE(c.c, 0) AS c, 1 + CAST(1000000000 AS HUGEINT) * (COALESCE(c.c, 0) + 1) // (n.n + v.v) AS p
  FROM n JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, t)),
ln AS (SELECT lang, sum(c) AS n FROM c GROUP BY lang),
q AS (
  SELECT lang, t, 1 + CAST(1000000000 AS HUGEINT) * (sum(c.c) + 1) // (any_value(ln.n) + any_value(v.v)) AS q
  FROM c JOIN ln USING (lang) JOIN v USING (lang) GROUP BY lang, t),
pair AS (
  SELECT a.lang, a.source, b.source AS item, COALESCE(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.t = x.t
  GROUP BY a.lang, a.source, b.source),
term AS (SELECT lang, source, t AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, t) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT *, 'term', row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
