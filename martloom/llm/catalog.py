"""The registered queries of the subpackage, with checking SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import chat_format, lexical_search, licenses, mixing, near_duplicates, packing, quality_rules, spelling, token_counts, token_files, topk_search, toxicity, url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str | Callable[[], str]] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def oracles() -> dict[str, str]:
    return {name: sql if isinstance(sql, str) else sql() for name, sql in _ORACLES.items()}


def query(name: str, oracle: str | Callable[[], str] | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if oracle is not None:
            _ORACLES[name] = oracle
        return build

    return register


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w
  FROM sized GROUP BY source),
shares AS (
  SELECT *, ((sum(source_size) OVER ()) - 3 * coalesce(sum(source_size) OVER o, 0))::DOUBLE
            / ((sum(w) OVER ()) - coalesce(sum(w) OVER o, 0)) AS share
  FROM per
  WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
factor AS (SELECT min_by(share, source_size / w) AS f FROM shares WHERE share * w <= 3 * source_size),
targets AS (
  SELECT source, source_size,
         CASE WHEN f IS NULL OR f * w > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE f * w END AS target
  FROM shares LEFT JOIN factor ON true),
numbered AS (
  SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % (64 + (SELECT count(*) FROM sized) // 100000) AS slice
  FROM sized),
placed AS (
  SELECT n.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY n.source ORDER BY size, slice, doc_id) - 1 AS i,
         ('0x' || substr(md5('mix' || coalesce('s' || n.source, 'n')), 1, 5))::BIGINT / 1048576.0 AS u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each
  FROM numbered n JOIN targets t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(floor((i + 1) * each + u) - floor(i * each + u), 3) * size)::BIGINT AS taken
FROM placed"""


@query("op2_mixing", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP3_SQL = r"""
WITH t AS (
  SELECT doc_id, ' ' || trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') || ' ' AS s
  FROM documents),
w AS (SELECT doc_id, s, CASE WHEN trim(s) = '' THEN [] ELSE string_split(trim(s), ' ') END AS w FROM t),
phrases(p, label, k) AS (
  VALUES ('under the mit license', 'mit', 4), ('apache license version 2', 'apache-2', 4), ('cc by nc', 'cc-by-nc', 3)),
near AS (SELECT doc_id, w, p, label, k FROM w JOIN phrases ON contains(s, ' ' || p || ' ')),
places AS (
  SELECT doc_id, label, i - 1 AS place
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM near) WHERE array_to_string(w[i:i + k - 1], ' ') = p),
base AS (
  SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
templates(label, ws) AS (VALUES TEMPLATES),
parts AS (SELECT ws, label, len(list_distinct(ws)) AS size, unnest(list_distinct(ws)) AS word FROM templates),
hits AS (
  SELECT doc_id, i, label, ws, size, word FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w)
  JOIN parts USING (word)),
met AS (
  SELECT doc_id, label, count(DISTINCT word) OVER (
           PARTITION BY doc_id, ws ORDER BY i RANGE BETWEEN CURRENT ROW AND 63 FOLLOWING) / size AS c
  FROM hits),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(c) AS c FROM met WHERE c >= 0.85 GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))),
                ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)""".replace(
    "TEMPLATES", ", ".join(f"('{a}', string_split('{b}', ' '))" for a, b in licenses.TEMPLATES))


@query("op3_license_scan", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents")).drop("group")


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""


@query("op6_topk_search", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op7_chat_formatting")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    chats = chat_format.formatted(table(spark, folder, "conversations"))
    return chats.withColumn("held_out", chat_format.is_held_out("conv_id"))


@query("op8_token_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = token_counts.token_counts(docs, tokenizer("piece_bpe_32k.model"), drop_text=True)
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op9_sql() -> str:
    model = url_filters.default_model()
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN ['{h}{p}', '{v}']"
        for v, h, p in sorted(url_filters.RULES, key=lambda r: -len(r[1]) - len(r[2])))
    return rf"""
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
g AS (
  SELECT *, CASE {fits} END AS said, list_distinct(list_concat(
         list_transform(range(1, length(host || path) - 1), lambda i: substr(host || path, i, 3)),
         list_transform(range(1, length(host || path) - 2), lambda i: substr(host || path, i, 4)))) AS grams
  FROM h),
w AS (SELECT {list(model.weights)} AS w),
s AS (
  SELECT g.*, {model.bias} + coalesce(list_sum(list_transform(grams,
         lambda x: w[('0x' || substr(md5(x), 1, 3))::INT + 1])), 0) AS score FROM g, w)
SELECT page_id, host, path, said[1] AS rule,
       coalesce(said[2], CASE WHEN score > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM s"""


@query("op9_url_filters", op9_sql)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.url_verdicts(table(spark, folder, "pages").select("page_id", "url")).drop("url", "score")


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
facts AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM lines),
rules AS (
  SELECT doc_id, line, len(w) AS words, length(array_to_string(w, '')) AS chars,
         length(array_to_string(w, '')) - length(regexp_replace(array_to_string(w, ''), '[#*$%&|<>]', '', 'g')) AS symbols,
         length(array_to_string(w, '')) - length(replace(array_to_string(w, ''), '!', '')) AS marks,
         len(list_distinct(w)) AS different,
         len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) AS again
  FROM facts WHERE len(w) > 0),
judged AS (
  SELECT doc_id, chars, symbols >= 0.08 * chars OR (marks >= 3 AND marks >= 0.5 * words)
         OR (words >= 8 AND (different < 0.35 * words OR again >= 0.3 * words))
         OR (words <= 25 AND regexp_matches(line, 'PHRASES', 'i')) AS fails
  FROM rules),
lost AS (
  SELECT doc_id, sum(chars) AS chars, sum(CASE WHEN fails THEN chars ELSE 0 END) AS gone FROM judged GROUP BY doc_id),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM rules GROUP BY doc_id),
tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(text, '') AS text
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM tokens)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, v) > 1),
spread AS (SELECT DISTINCT doc_id, i + k AS place FROM twice, range(0, 5) AS t(k)),
repeats AS (SELECT doc_id, count(*) AS n FROM spread GROUP BY doc_id),
counts AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone / chars, 0) AS lost
  FROM tokens t LEFT JOIN dups USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost <= 0.5 AS kept
FROM counts""".replace("PHRASES", "|".join(quality_rules.BOILERPLATE))


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs).drop("text", "clean_text", "lost")


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n FROM t WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
df AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, nn),
m AS (SELECT r, doc_id, (50 + (50 * n * nn) // l)::BIGINT AS m FROM d, total),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50"""


@query("op11_lexical_search", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_token_files")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.stored_tokens(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
         ELSE c >> 1 END) ORDER BY b) AS crc FROM (SELECT unnest(range(256)) AS b)),
run AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times FROM run WHERE length(run) >= 5 GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(s) + 1),
         lambda i: ('0x' || substr(hex(s), 2 * i - 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, times, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS s FROM counted), crc_table),
lost AS (
  SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
         ELSE run END AS word FROM hashed),
v AS (SELECT word, sum(times)::BIGINT AS n FROM lost WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM v a JOIN gaps b ON a.word = b.gap
  UNION SELECT b.word, a.word, a.n FROM v a JOIN gaps b ON a.word = b.gap),
near AS (SELECT a AS word, count(*)::BIGINT AS n_near, max(n) AS most FROM pairs GROUP BY a),
best AS (SELECT a AS word, min(b) AS form FROM pairs JOIN near ON a = near.word AND n = most GROUP BY a),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * v.n THEN form END AS form,
         CASE WHEN most >= 2 * v.n THEN most END AS form_n
  FROM v LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS last, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, max_by(last, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


@query("op13_spelling_variants", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))
