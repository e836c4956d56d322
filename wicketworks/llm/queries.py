"""The registered queries: each applies its operator to a whole table and keeps the agreed columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from wicketworks.llm.divergence import source_divergence
from wicketworks.llm.grid_join import near_vectors
from wicketworks.llm.language import identify_languages
from wicketworks.llm.line_dedup import dedup_lines
from wicketworks.llm.mixing import mix
from wicketworks.llm.packing import pack
from wicketworks.llm.registry import ORACLES, QUERIES, query, table, tokenizer
from wicketworks.llm.reply_trees import format_chains, read_back
from wicketworks.llm.sharding import shard_by_bytes
from wicketworks.llm.simhash import hex_fingerprint, near_duplicates
from wicketworks.llm.spelling import spelling_variants
from wicketworks.llm.token_counts import count_tokens
from wicketworks.llm.topk import top_k
from wicketworks.llm.training_order import write_training_order

__all__ = ["ORACLES", "QUERIES"]


@query("op1_crf_language")
def _(spark, directory):
    return identify_languages(table(spark, directory, "documents"))


@query("op2_best_fit_packing")
def _(spark, directory):
    return pack(table(spark, directory, "documents"), tokenizer("word_bpe_49k.json"))


@query("op3_line_dedup")
def _(spark, directory):
    kept = dedup_lines(table(spark, directory, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.octet_length("text").cast("long").alias("n_bytes"), F.crc32("text").alias("text_crc32"))


@query("op4_training_order")
def _(spark, directory):
    return write_training_order(table(spark, directory, "documents"), tokenizer("byte_bpe_50k.json"))[0]


@query("op5_simhash_near_duplicates")
def _(spark, directory):
    groups = near_duplicates(table(spark, directory, "documents"))
    return groups.withColumn("fingerprint", hex_fingerprint(F.col("fingerprint")))


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
             ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / sum(weight) OVER (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sums
), targets AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END * source_size AS rest
  FROM (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM levels)
), running AS (
  SELECT d.doc_id, d.size, t.*, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), gaps AS (
  SELECT source, any_value(rest) - coalesce(max(upto) FILTER (upto <= rest), 0) AS gap FROM running GROUP BY source
), closing AS (
  SELECT r.source, arg_min(r.upto, (abs(r.size - g.gap), r.upto)) AS closing
  FROM running r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source
  WHERE r.upto > r.rest AND r.size > 0 AND abs(r.size - g.gap) < g.gap GROUP BY r.source
)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.passes + CASE WHEN (r.upto <= r.rest AND r.rest > 0) OR r.upto = c.closing THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running r LEFT JOIN closing c ON r.source IS NOT DISTINCT FROM c.source
"""


@query("op6_mixing", MIXING_SQL)
def _(spark, directory):
    mixed = mix(table(spark, directory, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))


@query("op8_histogram_shards")
def _(spark, directory):
    placed = shard_by_bytes(table(spark, directory, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op10_token_counts")
def _(spark, directory):
    counted = count_tokens(table(spark, directory, "documents"), tokenizer("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query(
    "op9_block_pruned_top_k",
    """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM clean q JOIN clean d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""",
)
def _(spark, directory):
    return top_k(table(spark, directory, "embeddings"))


@query(
    "op7_grid_order_join",
    """
WITH RECURSIVE clean AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM clean a JOIN clean b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON r.vec_id = l.a
), least AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts ON vec_id = a
""",
)
def _(spark, directory):
    return near_vectors(table(spark, directory, "embeddings"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS raw_role, text AS raw_text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), written AS (
  SELECT *, md5('0:' || coalesce(raw_text, 'null'))[1:15] AS h, '<|im_start|>' || url_encode(role) || chr(10) ||
    regexp_replace(regexp_replace(replace(text, '\', '\\'),
      '<(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)', '<\\\1', 'g'), '\[(INST\]|/INST\])', '[\\\1', 'g')
    || '<|im_end|>' || chr(10) AS formatted
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, raw_role NULLS FIRST, h)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, raw_role NULLS FIRST, h) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


@query("op11_reply_trees", CHAT_SQL)
def _(spark, directory):
    rows = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    back = read_back(format_chains(rows.unionByName(planted), "conv_id", "turn"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


@query("op12_spelling_variants")
def _(spark, directory):
    return spelling_variants(table(spark, directory, "documents"))


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), groups AS (SELECT DISTINCT lang, source FROM docs),
uses AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs) AS d GROUP BY ALL
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs) AS d GROUP BY ALL HAVING count(*) >= 3
), langs AS (
  SELECT k.lang, k.term, sum(u.n)::HUGEINT AS n FROM kept k JOIN uses u ON k.lang = u.lang AND k.term = u.term GROUP BY ALL
), lang_sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM langs GROUP BY lang),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
), probable AS (
  SELECT c.*, (1 + (1000000000::HUGEINT * (c.n + 1)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source)::HUGEINT + s.v)) AS p
  FROM cells c JOIN lang_sizes s ON c.lang = s.lang
), pairs AS (
  SELECT g.lang, g.source, o.source AS item FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM probable a JOIN probable b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), valued AS (
  SELECT p.lang, p.source, 'pair' AS part, p.item, coalesce(s.value, 0)::BIGINT AS value
  FROM pairs p LEFT JOIN sums s ON p.lang = s.lang AND p.source = s.source AND p.item = s.item
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT
  FROM (SELECT c.*, (1 + (1000000000::HUGEINT * (l.n + 1)) // (s.total + s.v)) AS q
        FROM probable c JOIN langs l ON c.lang = l.lang AND c.term = l.term JOIN lang_sizes s ON c.lang = s.lang) AS x
  WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM valued QUALIFY part = 'pair' OR rank <= 200
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def _(spark, directory):
    return source_divergence(table(spark, directory, "documents"))
