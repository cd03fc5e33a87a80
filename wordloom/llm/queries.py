"""The operators of this package over whole test tables: ``opN_<name>``. Each derives its digest columns from the operator's rows."""

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import bpe, cotraining, divergence, hnsw, interactions, language, lm, packing, pieces, pii, rules, secrets, simhash
from wordloom.llm.common import map_batches, table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``spans`` are start:end of the secrets, comma-joined; ``top_probability`` is null without a candidate."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets.scan(documents, keep={"doc_id": "doc_id"})
    spans = F.transform("secrets", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id", F.size("candidates").cast("bigint").alias("n_candidates"), F.size("secrets").cast("bigint").alias("n_secrets"),
        F.array_join(spans, ",").alias("spans"), F.array_max("candidates.probability").alias("top_probability"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(documents, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)


def op6_bpe_codec(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, vocabulary, keep=["doc_id"])
    both = bpe.decode(encoded, vocabulary)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.personal_data(documents, keep=["doc_id"]))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return interactions.audit(documents, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def _id_bytes_digest():
    """Of each list of ids, the SHA-256 of its numbers as four bytes each, the lowest first."""
    def each(batch):
        lists = batch.column(1)
        ids, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        return [pa.array([hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string())]

    return each


def op12_piece_codec(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """``ids_unequal`` says whether the sentencepiece library has other ids for any chunk of the text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.round_trip(documents, model or public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    found = both.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "ids_unequal", F.sha2("decoded", 256).alias("decoded_sha256"))
    return map_batches(found, _id_bytes_digest, "ids_sha256 string", keep=["doc_id", "n_tokens", "decoded_sha256", "ids_unequal"])


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_secret_scan, op3_quality_rules, op4_quality_classifier, op5_simhash_dedup, op6_bpe_codec,
    op7_class_lm, op8_language_id, op9_best_fit_packing, op10_personal_data, op11_filter_interactions,
    op12_piece_codec, op13_source_divergence)}

_INTERACTIONS = r"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS whole,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT f.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, {
    'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(whole, '[^A-Z]', '', 'g')) > 3 * length(whole),
    'D': regexp_matches(whole, '[#$%&*|]'), 'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY whole), false)} AS fails
  FROM facts f LEFT JOIN labelled l USING (doc_id)),
cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f FROM orders, (SELECT unnest(range(1, 6)) AS step)),
long AS (
  SELECT part, n, good, toxic, fails, unnest(map_entries(MAP {
    'A': fails.A, 'B': fails.B, 'C': fails.C, 'D': fails.D, 'E': fails.E})) AS entry FROM cells),
cell_lists AS (
  SELECT part, fails, any_value(n) AS n, any_value(good) AS good, any_value(toxic) AS toxic,
    coalesce(list(entry.key) FILTER (WHERE entry.value), []) AS failing
  FROM long GROUP BY part, fails),
moves AS (
  SELECT part, filter_order, step, f, n, good, toxic, list_contains(failing, f) AS hit,
    len(list_filter(failing, lambda x: position(x IN left(filter_order, step - 1)) > 0)) AS before, len(failing) AS failures
  FROM cell_lists, steps),
totals AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN before = 0 AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN before = 0 AND hit THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN before > 0 AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failures = 1 AND hit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN before = 0 AND hit THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN before = 0 AND hit THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM moves GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM totals"""

_DIVERGENCE = r"""
WITH found AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
groups AS (SELECT DISTINCT lang, source FROM found),
rows AS (SELECT lang, source, d, unnest(terms) AS term FROM found),
kept AS (SELECT lang, term, count(*) AS total FROM rows GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM rows SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
terms AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
sized AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS size FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT k.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.size + 5 * t.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (t.n + 5 * t.v) AS q
  FROM kept k JOIN terms t USING (lang) JOIN sized s USING (lang)
  LEFT JOIN counts c ON c.lang = k.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 50"""

#: Queries whose rows SQL can state. The others are compared with brute force in the tests.
ORACLE: dict[str, str] = {
    "op11_filter_interactions": _INTERACTIONS,
    "op13_source_divergence": _DIVERGENCE,
}
