"""Thin registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexivane.llm import bpe, chat, embdup, html_extract, media, mixing, neardup, quality, token_files, toxicity
from lexivane.llm.common import table, work_path


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_of(key, folds: int, held: int):
    """True for rows of the fold that isn't learned from; rows without a key aren't either."""
    return F.coalesce((F.crc32(key.cast("string")) % folds) == held, F.lit(True))


def toxicity_model(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").filter(~split_of(F.col("doc_id"), 4, 2))
    return toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.select("doc_id", split_of(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def quality_model(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").filter(~split_of(F.col("doc_id"), 5, 0))
    return quality.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", split_of(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_media_columns(spark, sf_dir):
    return media.media_columns(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_minhash_dedup(spark, sf_dir):
    return neardup.components(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85).drop("node", "tie")


def op6_embedding_dedup(spark, sf_dir):
    return embdup.components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op4_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


PLANTED_CHAT = """
SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)
"""


def op7_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(PLANTED_CHAT))
    return chat.digests(chat.read_back(chat.format_chats(chat.from_turns(turns))))


def op8_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mixing.copies(docs)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))


def op9_bpe_codec(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokenizer_path(), decoded_col="decoded")
    return coded.select("doc_id", *bpe.digests(coded))


def op10_token_files(spark, sf_dir):
    out = work_path(spark, "ids")
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), out, tokenizer_path())
    return token_files.read(spark, out)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_media_columns": op3_media_columns,
    "op4_html_extract": op4_html_extract,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_mix_sources": op8_mix_sources,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_token_files": op10_token_files,
}

ORACLE_SQL: dict[str, str] = {
    "op6_embedding_dedup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings
), ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND norm > 0 AND isfinite(norm) AND len(list_filter(e, lambda x: x IS NULL)) = 0
), l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.95
), n AS (
  SELECT a, count(*) AS n FROM l GROUP BY a
), r(a, c) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a
), c AS (
  SELECT a, min(c) AS c FROM r GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
    "op5_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (
  SELECT doc_id, len(s)::BIGINT AS n FROM s
), e AS (
  SELECT doc_id, unnest(s) AS x FROM s
), i AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), both_ways AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(a, c) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM r JOIN both_ways l ON l.a = r.a
), c AS (
  SELECT a, min(c) AS c FROM r GROUP BY a
)
SELECT doc_id, n AS n_shingles, c AS component_id, doc_id = c AS kept FROM n JOIN c ON c.a = doc_id
""",
    "op7_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)
), e AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b'), chr(10), '\n'))
          + length(replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\b')) + 24 AS n FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned, sum(n)::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
""",
    "op8_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM s
), r AS (
  SELECT *, 3.0::DOUBLE * source_size AS most, 3.0::DOUBLE * source_size / weight AS ratio FROM w
), q AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS rate
  FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT (SELECT rate FROM q WHERE ratio >= rate ORDER BY ratio, source NULLS LAST LIMIT 1) AS final
), g AS (
  SELECT source, source_size, CASE WHEN final IS NULL OR ratio < final THEN most ELSE final * weight END::DOUBLE AS target,
         ('0x' || substr(md5('20:' || coalesce(source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM r, f
), k AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS c,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS i
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, (size * (floor(i * c + u) - floor((i - 1) * c + u)))::BIGINT AS taken FROM k
""",
}
