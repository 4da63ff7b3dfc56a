"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontam, fingerprints, hard_negatives, langid, licenses, masked_lm, mixing, sharding, simhash, toxicity, urls
from .common import documents, map_rows


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity grade and expected severity of every document."""
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity.grade(docs.select("doc_id", "text"), model).drop("text")


#: Fixed values of the contract: the conversation added to the table, and the URL rules.
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
RULES = [urls.Rule("net", "/", urls.BLOCK), urls.Rule("example.net", "/en/", urls.ALLOW), urls.Rule("example.com", "/de/", urls.BLOCK), urls.Rule("org", "/fr/", urls.ALLOW)]


def _read_back(batches):
    for b in batches:
        out = []
        for i, text, loss in zip(*(c.to_pylist() for c in b.columns)):
            turns, mask = chat.read_back(text), chat.under_mask(text, [(x["start"], x["end"]) for x in loss])
            told = "".join(f"{r}\n{t}\n" for r, t in turns)
            out.append((i, len(turns), sha256(told.encode()).hexdigest(), len(mask), sha256(mask.encode()).hexdigest(), len(text)))
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                         names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what the formatted text gives back."""
    table = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    table = table.unionByName(spark.createDataFrame(ADDED, table.schema))
    chosen = chat.paths(chat.chain(table, "conv_id", ["turn", "role", "text"]), tree="conv_id")
    done = chat.conversations(chosen, tree="conv_id").select(F.col("tree").cast("long").alias("conv_id"), "formatted", "loss")
    return map_rows(done, _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(documents(spark, sf_dir))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urls.judge(documents(spark, sf_dir, "pages"), RULES)


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document."""
    docs = documents(spark, sf_dir)
    return masked_lm.score(docs.select("doc_id", "text"), masked_lm.fit(docs)).drop("text")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned without the held-out quarter."""
    docs = documents(spark, sf_dir)
    model = langid.LanguageClassifier(langid.fit_dictionaries(docs, where=~langid.held_out()))
    judged = langid.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document."""
    docs = documents(spark, sf_dir)
    return licenses.scan(docs, licenses.fit(docs))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return fingerprints.compare_in_order(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return decontam.decontaminate(docs, documents(spark, sf_dir, "benchmark")).drop("text")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    d = simhash.near_duplicates(documents(spark, sf_dir), shingle_words=3, max_bits=3)
    return d.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near equal bytes."""
    return sharding.place_documents(documents(spark, sf_dir), shards=16)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    return alignment.document_links(documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive of the embeddings."""
    v, label = documents(spark, sf_dir, "embeddings"), F.col("label").cast("long")
    told = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(v.select("vec_id", "embedding", told.alias("label")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_chat, op3_mixing, op4_urls, op5_masked_lm, op6_langid, op7_licenses, op8_fingerprints, op9_decontamination, op10_simhash,
    op11_sharding, op12_alignment, op13_hard_negatives)}

#: Queries that SQL expresses on whole tables in reasonable time.
ORACLE_SQL: dict[str, str] = {
    "op2_chat": r"""
WITH added(conv_id, turn, role, "text") AS (
  VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce("text", '') AS t
  FROM (SELECT conv_id, turn, role, "text" FROM conversations UNION ALL SELECT * FROM added)),
told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t) AS turns,
    coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '') AS said,
    sum(9 + 7 + 4 + length(r) + length(t) + len(regexp_extract_all(r, '[<\[]\\*(?:/?s>|/?INST\])')) + len(regexp_extract_all(t, '[<\[]\\*(?:/?s>|/?INST\])'))) AS n
  FROM rows_ GROUP BY conv_id)
SELECT conv_id::BIGINT AS conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(said)::BIGINT AS loss_chars, sha256(said) AS loss_sha256, n::BIGINT AS formatted_chars
FROM told""",
    "op9_decontamination": r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE "text" IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + 12), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
place AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
found AS (SELECT place.doc_id, place.n, place.i, win.item_id FROM place JOIN win ON place.n = win.n AND place.s = win.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY doc_id)
SELECT doc.doc_id, len(doc.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(doc.w), false) AS contaminated
FROM doc LEFT JOIN hit ON hit.doc_id = doc.doc_id LEFT JOIN items ON items.doc_id = doc.doc_id""",
    "op13_hard_negatives": r"""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
