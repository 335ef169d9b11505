"""The registered queries of the operators, with production parameters, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm import (
    chat, decontaminate, jaccard, langid, lm, mixing, prefixes, quality, tokens, topk, toxicity, urls, whitening,
)
from ledgerlark.llm.common import is_remainder, reachable, remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(reachable(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


@query()
def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = lm.score_texts(docs, is_remainder(F.col("doc_id"), 7, 2))
    return scored.select("doc.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.select("doc.doc_id", "n_bytes", "n_tokens", "over_limit")


@query("""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    substr(md5(concat_ws(chr(31), doc_id::VARCHAR, text)), 1, 15) AS hash FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
o AS (SELECT arg_min(level, cap / weight) AS settled FROM l WHERE level * weight <= cap),
t AS (SELECT source, size, least(cap, coalesce(settled * weight, cap)) AS target FROM l, o),
b AS (SELECT source, size AS source_size, target, CASE WHEN size > 0 THEN floor(target / size) ELSE 0 END AS times,
    CASE WHEN size > 0 THEN target - floor(target / size) * size ELSE 0 END AS budget FROM t),
h AS (SELECT source, hash, sum(size) AS n FROM d WHERE size > 0 GROUP BY source, hash),
c AS (SELECT h.*, sum(n) OVER (PARTITION BY source ORDER BY hash) AS upto FROM h),
f AS (SELECT c.source, min(hash) AS hash, arg_min(upto - n, hash) AS below, arg_min(n, hash) AS at
      FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source WHERE upto > budget GROUP BY c.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
  (d.size * (b.times + CASE WHEN d.hash < f.hash OR (d.hash = f.hash AND f.below + f.at - b.budget < b.budget - f.below)
     THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
""")
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, weights=(5, 2, 1), most=3)
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


@query("""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM p),
r(verdict, rule, rule_host, rule_path) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
m AS (SELECT q.page_id, q.host, q.path, rule, verdict, rule_host, rule_path FROM q LEFT JOIN r
  ON (q.host = rule_host OR ends_with(q.host, '.' || rule_host)) AND starts_with(q.path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) = 1
""")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page.page_id", "host", "path", "rule", "verdict")


@query("""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, max(i) AS at FROM t WHERE role = 'assistant' GROUP BY conv_id),
p AS (SELECT k.conv_id, y.conv_id AS other_id, x.at AS at, y.at AS other_at FROM (SELECT DISTINCT conv_id FROM t) k
  LEFT JOIN a x ON x.conv_id = k.conv_id LEFT JOIN a y ON y.conv_id = xor(x.conv_id, 1)),
r AS (SELECT p.conv_id, t.i, t.role, t.text FROM p JOIN t ON t.conv_id = p.conv_id WHERE t.i < p.at AND p.other_id IS NOT NULL
  UNION ALL SELECT p.conv_id, p.at, t.role, t.text FROM p JOIN t ON t.conv_id = p.other_id AND t.i = p.other_at),
c AS (SELECT t.* FROM t JOIN p USING (conv_id)),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.i, r.i) AS i,
  c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AND c.i IS NOT NULL AND r.i IS NOT NULL AS same
  FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.i = r.i),
n AS (SELECT conv_id, coalesce(min(i) FILTER (NOT same), max(i) + 1) - 1 AS n_prefix FROM j GROUP BY conv_id),
u AS (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r', * FROM r),
v AS (SELECT u.*, n_prefix, '<|' || role || '|>' || chr(10) AS head, i > n_prefix AS tail FROM u JOIN n USING (conv_id)),
z AS (SELECT *, head || text || chr(10) || '<|end|>' || chr(10) AS line,
  coalesce(sum(length(head || text) + 9) OVER (PARTITION BY side, conv_id, tail ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
   + length(head) AS b FROM v),
g AS (SELECT side, conv_id, any_value(n_prefix) AS n_prefix, coalesce(string_agg(line, '' ORDER BY i) FILTER (NOT tail), '') AS prompt,
  coalesce(string_agg(line, '' ORDER BY i) FILTER (tail), '') AS completion,
  coalesce(string_agg(b::BIGINT || '-' || (b + length(text))::BIGINT, ',' ORDER BY i) FILTER (tail AND role = 'assistant'), '') AS mask
  FROM z GROUP BY side, conv_id)
SELECT p.conv_id, p.other_id, x.n_prefix::INT AS n_prefix, x.prompt, x.completion AS chosen_text,
  coalesce(y.completion, '') AS rejected_text, x.mask AS chosen_mask, coalesce(y.mask, '') AS rejected_mask
FROM p JOIN g x ON x.conv_id = p.conv_id AND x.side = 'c' LEFT JOIN g y ON y.conv_id = p.conv_id AND y.side = 'r'
""")
def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    pairs = chat.swapped_answers(chat.conversation_turns(turns))
    return chat.format_preferences(pairs).drop("chosen", "rejected")


@query()
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    judged = langid.identify(docs, is_remainder(F.col("doc_id"), 4, 2), keep=["doc_id"])
    return judged.select("doc.doc_id", "held_out", "lang_pred", "score")


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, labels, is_remainder(F.col("doc_id"), 3, 1), keep=["doc_id"])
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


@query("""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3
    THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, coalesce(len(sh), 0) AS n FROM s),
u AS (SELECT doc_id, hash(unnest(sh)) AS h FROM s),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM u a JOIN u b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.root) AS component_id FROM n JOIN r USING (doc_id) GROUP BY ALL
""")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.near_duplicates(docs, n=3, percent=90).select("doc.doc_id", "n_shingles", "component_id")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY rank <= 20
""")
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20, scale=64)


@query("""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS hi, 'abcdefghijklmnopqrstuvwxyz' AS lo),
d AS (SELECT doc_id, regexp_extract_all(translate(text, hi, lo), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents, low),
i AS (SELECT item_id, regexp_extract_all(translate(text, hi, lo), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark, low),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[p:p + least(10, len(ws)) - 1], ' ') AS win
  FROM i, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS r(p) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, p, size, array_to_string(ws[p:p + size - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, greatest(len(ws) - size + 2, 1))) AS r(p)),
h AS (SELECT doc_id, item_id, p, dw.size FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM h, unnest(range(p, p + size)) AS r(x) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.contamination(docs, bench, window=10, k=5)
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    scored = quality.score_quality(docs, labels, is_remainder(F.col("doc_id"), 5, 0), keep=["doc_id"])
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length({0}) + 1), lambda i: ord({0}[i])::BIGINT),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@query(f"""
WITH t AS (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, words) AS i, digest, words FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS first, {CRC32.format("(conv_id::VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, i, digest, words FROM c JOIN o ON o.conv_id = c.first AND i <= h
  UNION ALL SELECT c.conv_id, i, digest, words FROM c JOIN o ON o.conv_id = c.conv_id AND i > h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, digest, words FROM b),
p AS (SELECT conv_id, d, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d) AS prefix FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT prefix, min(conv_id) AS conv_id, d, any_value(words) AS words, count(*) AS n_convs FROM p GROUP BY prefix, d),
l AS (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id),
e AS (SELECT p.prefix, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM l JOIN p USING (conv_id, d) GROUP BY p.prefix),
k AS (SELECT left(prefix, length(prefix) - 32) AS prefix, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (prefix)),
s AS (SELECT a.prefix, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.words)::BIGINT AS saved_tokens
  FROM f JOIN p a ON a.conv_id = f.conv_id AND a.d <= f.d GROUP BY a.prefix)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM f JOIN s USING (prefix) LEFT JOIN e USING (prefix) LEFT JOIN n u ON f.d > 0 AND u.prefix = left(f.prefix, length(f.prefix) - 32)
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    opened = prefixes.shared_openings(prefixes.turn_marks(turns), 20, remainder(F.col("conv_id"), 4), 3)
    return prefixes.prefix_trie(opened)


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    found = whitening.whiten(vectors, components=4, scale=256, keep=["vec_id"])
    return found.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
