"""The registered queries of this subpackage: thin digests of what the operators give."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import embeddings, katz, langid, licences, mixing, parsing, pieces, quality, ranking, simhash, toxicity, trie, urls
from wattlake.llm.common import fold, table

#: The folder of public vocabulary files, and the model that is used of it.
TOKENIZERS = os.environ.get("WATTLAKE_TOKENIZERS", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.against_next(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity.learn(documents, table(spark, sf_dir, "labels")))
    score = F.col("_tox.score")
    return scored.select("doc_id", (F.coalesce(fold("doc_id", 3), F.lit(0)) == 1).alias("held_out"), score.alias("score"), (score >= toxicity.LIMIT).cast("int").alias("predicted"), F.array_join("_tox.matches", ",").alias("matches"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every whole text and decodes its ids again; the ids themselves as a SHA-256 of their list."""
    return pieces.round_trips(table(spark, sf_dir, "documents"), pieces.read_model(PIECES))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).withColumn("purity", F.round("purity", 9))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(documents, quality.learn(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (F.coalesce(fold("doc_id", 3), F.lit(0)) == 1).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= quality.LIMIT).cast("int").alias("predicted"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(documents, langid.learn(documents))
    return found.select("doc_id", (F.coalesce(fold("doc_id", 5), F.lit(1)) == 0).alias("held_out"), F.col("_lang.lang_pred").alias("lang_pred"), F.col("_lang.score").alias("score"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_components(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(simhash.fingerprints(table(spark, sf_dir, "documents"), words=3, lanes=1), radius=3)
    return found.select("doc_id", simhash.hex_fingerprint(["f0"]).alias("fingerprint"), "component_id")


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which licences each whole text names, from where to where, and how well the best of them fits."""
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("licences", lambda p: F.concat_ws(":", p["licence"], p["first"].cast("string"), p["after"].cast("string")))
    return found.select("doc_id", F.size("licences").cast("long").alias("n_licences"), F.array_join(F.array_sort(F.array_distinct("licences.licence")), ",").alias("licences"), F.array_join(spans, ",").alias("passages"), F.round(F.array_max("licences.score"), 9).alias("best_score"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.score(table(spark, sf_dir, "documents").select("doc_id", "text"), fold("doc_id", 5) != 1)
    held_out = (F.coalesce(fold("doc_id", 5), F.lit(0)) == 1).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    operators = (op1_fingerprints, op2_toxicity, op3_sentencepiece, op4_url_filter, op5_quality, op6_language_id, op7_mixing, op8_embeddings, op9_simhash, op10_licences, op11_prefix_trie, op12_lm_scores, op13_ranked_search)
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


OP8_SQL = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(e) = list_count(e) AND isfinite(list_sum(e)) AND (list_min(e) <> 0 OR list_max(e) <> 0)),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
n AS (SELECT x, count(*) AS n FROM link GROUP BY 1), c AS (SELECT x, min(y) AS m FROM reach GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept FROM v LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id"""


# crc32 a bit at a time (i): bytes go in at every eighth
OP11_SQL = r"""WITH RECURSIVE crc AS (
  SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, s, i + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END AS x FROM crc WHERE i < 8 * length(s))),
h AS (SELECT c, c - c % 20 AS b, xor(v, 4294967295) % 4 AS h FROM crc WHERE i = 8 * length(s)),
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g, w) AS pos, g, w FROM (
  SELECT conv_id, turn, sha256(CAST(strlen(r) AS VARCHAR) || ':' || r || x) AS g, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce("text", '') AS x FROM conversations WHERE conv_id IS NOT NULL))),
lent AS (SELECT h.c, t.pos, t.g, t.w FROM h JOIN t ON t.c = h.b AND t.pos <= h.h),
f AS (SELECT * FROM lent UNION ALL SELECT c, t.pos - h.h + (SELECT count(*) FROM lent WHERE lent.c = h.c), g, w FROM h JOIN t USING (c) WHERE t.pos > h.h),
p AS (SELECT c, pos AS d, string_agg(g, ',') OVER (PARTITION BY c ORDER BY pos) AS k, w FROM f UNION ALL SELECT c, 0, '', 0 FROM h),
e AS (SELECT c, d, k, w, d = max(d) OVER (PARTITION BY c) AS is_end FROM p),
n AS (SELECT d, k, min(c) AS rep, count(*) AS n, max(w) AS w, bool_and(is_end) AS leaf, coalesce(string_agg(CASE WHEN is_end THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends FROM e GROUP BY d, k),
below AS (SELECT p.d, p.k, sum(CAST(n.leaf AS BIGINT)) AS leaves, sum((n.n - 1) * n.w) AS saved, count(*) FILTER (WHERE n.d = p.d + 1) AS kids
  FROM n JOIN p ON p.c = n.rep AND p.d <= n.d GROUP BY p.d, p.k),
up AS (SELECT p.c, p.d, n.rep FROM p JOIN n USING (d, k))
SELECT n.rep AS conv_id, CAST(n.d AS BIGINT) AS depth, up.rep AS parent_conv_id, n.n AS n_convs, CAST(kids AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM n JOIN below USING (d, k) LEFT JOIN up ON up.c = n.rep AND up.d = n.d - 1"""

# an item's or a document's row is its own, whatever ids repeat
OP13_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d),
b AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM b GROUP BY ALL),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, s.n),
p AS (SELECT i, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * f.n * s.n) // s.l)))) AS BIGINT) AS score FROM q JOIN f USING (term) JOIN w USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0 QUALIFY rank <= 20"""


def oracle_sql() -> dict[str, str]:
    """SQL of vectors' links, the trie and the ranked search: the others learn, hash or parse as SQL can't, and are tested against brute force."""
    return {"op8_embeddings": OP8_SQL, "op11_prefix_trie": OP11_SQL, "op13_ranked_search": OP13_SQL}
