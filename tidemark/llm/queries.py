"""The registered queries of this package, with their production parameters and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    alignment, archives, chat, decontamination, fill_middle, language, mixing, ngram_join, secrets, token_files, toxicity, url_filter, vector_search)
from tidemark.llm.folders import folder as scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM words, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r USING (doc_id) GROUP BY 1, 2
""")
def op6_ngram_jaccard(spark, folder):
    found = ngram_join.near_duplicates(_table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@query("""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM w, lengths, unnest(generate_series(1, len(w) - n + 1)) AS t(i) WHERE len(w) >= n),
found AS (SELECT doc_id, item, d.n, i FROM doc_windows d JOIN item_windows x ON d.n = x.n AND d.g = x.g),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM found, unnest(generate_series(i, i + n - 1)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op1_decontamination(spark, folder):
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: Fixed by the contract of op8: the tokenizer's file and the id at the end of each document.
TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op8_token_files(spark, folder):
    return token_files.write_tokens(
        _table(spark, folder, "documents"), scratch(spark, "tokens"), tokenizer_path(), END_ID).withColumnRenamed("id", "doc_id")


def held_out(column: str, divisor: int, remainder: int):
    """Rows that no model learns from: CRC-32 of the id as text, by its remainder."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % divisor == remainder, F.lit(False))


@query()
def op9_language_id(spark, folder):
    documents = _table(spark, folder, "documents")
    model = language.fit(documents.where(~held_out("doc_id", 4, 2)))
    return language.predict(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
-- sources in the order in which they fill up: the first ones stop at three times their size
f AS (SELECT *, coalesce(sum(3 * n) OVER o, 0) AS spent, sum(w) OVER (ORDER BY 3 * n / w DESC, source ROWS UNBOUNDED PRECEDING) AS rest,
             sum(n) OVER () AS total FROM s WINDOW o AS (ORDER BY 3 * n / w, source DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT min(3 * n / w) AS mark FROM f WHERE (total - spent) / rest <= 3 * n / w),
level AS (SELECT (max(total) - coalesce(sum(3 * n) FILTER (WHERE 3 * n / w < mark), 0)) AS left_over, sum(w) FILTER (WHERE 3 * n / w >= mark) AS open_weight, max(mark) AS mark
  FROM f, stop),
t AS (SELECT source, n, CASE WHEN 3 * n / w < mark THEN 3 * n ELSE left_over * w / open_weight END AS target FROM f, level),
p AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM t),
h AS (SELECT source, hash, sum(size) AS inside, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash ROWS UNBOUNDED PRECEDING) AS upto
  FROM d GROUP BY source, hash),
x AS (SELECT h.source, h.hash, CASE WHEN upto < target - whole * n THEN 1
    WHEN upto - inside < target - whole * n AND 2 * (target - whole * n - upto + inside) >= inside THEN 1 ELSE 0 END AS more
  FROM h JOIN p ON h.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size::BIGINT AS size, p.n::BIGINT AS source_size, p.target, (d.size * (whole + more))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN x ON x.source IS NOT DISTINCT FROM d.source AND x.hash = d.hash
""")
def op10_mixing(spark, folder):
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rules(kind, rank, pattern, grp, least) AS (VALUES
  ('assign', 0, '(?i:(password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  ('access', 1, 'AKIA[A-Z0-9]{16,}', 0, 20), ('hex', 2, '[0-9a-f]{24,}', 0, 24)),
pieces AS (
  SELECT doc_id, kind, rank, least, regexp_extract_all(text, pattern) AS m, regexp_extract_all(text, pattern, grp) AS g,
         string_split_regex(text, pattern) AS b FROM d, rules),
places AS (
  SELECT doc_id, kind, rank, least, i, len(m[i]) AS size, len(g[i]) AS counted,
         list_sum(list_transform(b[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0) AS start
  FROM pieces, unnest(generate_series(1, len(m))) AS t(i)),
spans AS (SELECT doc_id, kind, rank, start::BIGINT AS start, (start + size)::BIGINT AS after FROM places WHERE counted >= least),
s AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS c, count(*) FILTER (WHERE kind = 'hex') AS h,
             string_agg(kind || ':' || start || ':' || after, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)
""")
def op2_secret_scan(spark, folder):
    found = secrets.scan(_table(spark, folder, "documents"), scratch(spark, "ledger"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = secrets.joined(F.col("spans"))
    return found.select(F.col("path").alias("doc_id"), *[number(r.kind) for r in secrets.BASE_RULES],
                        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


@query()
def op3_toxicity(spark, folder):
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.ToxicityModel.fit(documents, labels.where(~held_out("doc_id", 5, 0)))
    return model.score(documents).select(
        F.col("id").alias("doc_id"), held_out("id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op4_url_filter(spark, folder):
    return url_filter.judge(_table(spark, folder, "pages")).withColumnRenamed("id", "page_id")


@query("""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(0) || text)) AS place FROM t),
c AS (SELECT conv_id, list(role || chr(0) || text ORDER BY place) AS turns FROM p GROUP BY conv_id),
kept AS (SELECT conv_id, len(turns) AS n_turns FROM c a WHERE NOT EXISTS (
  SELECT 1 FROM c b WHERE b.turns[1] = a.turns[1] AND len(b.turns) >= len(a.turns) AND b.turns[:len(a.turns)] = a.turns
    AND (len(b.turns) > len(a.turns) OR b.conv_id < a.conv_id OR (a.conv_id IS NULL AND b.conv_id IS NOT NULL))))
SELECT p.conv_id, ((place - 1) // 256)::BIGINT AS part, any_value(n_turns)::BIGINT AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY place) AS text
FROM p JOIN kept ON p.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL
""")
def op5_chat_format(spark, folder):
    return chat.render(_table(spark, folder, "conversations")).withColumnRenamed("conv", "conv_id")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op7_vector_search(spark, folder):
    vectors = _table(spark, folder, "embeddings")
    return vector_search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0)).withColumnRenamed("id", "vec_id")


@query("""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
x AS (SELECT *, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS two FROM d),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[:least(one, two)], '') AS p, array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
    array_to_string(u[greatest(one, two) + 1:], '') AS s FROM x)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN len(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
""")
def op12_fill_middle(spark, folder):
    return fill_middle.digests(_table(spark, folder, "documents"), rate=100, spm=50, seed=7).withColumnRenamed("id", "doc_id")


@query()
def op13_token_alignment(spark, folder):
    aligned = alignment.align(_table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return aligned.withColumnRenamed("id", "doc_id")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT *, strlen(body) AS n, sha1(body) AS hex FROM p),
f AS (SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first FROM h WINDOW w AS (PARTITION BY hex ORDER BY page_id NULLS LAST)),
b AS (SELECT *, list_transform(generate_series(0, 31), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(hex, (5 * (i // 4) + 1)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) % 32, 1)) AS digits FROM f)
SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(digits, '') AS payload_digest,
       CASE WHEN n >= 0 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 0 AND place > 1 THEN first END AS refers_to
FROM b
""")
def op11_warc(spark, folder):
    home = scratch(spark, "archives")
    archives.write_arc(_table(spark, folder, "pages"), f"{home}/arc")
    archives.convert(spark, f"{home}/arc", f"{home}/warc", least=0)
    return archives.read_warc(spark, f"{home}/warc").where("record_type <> 'warcinfo'").select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))
