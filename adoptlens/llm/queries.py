"""The registered query of each operator, with production parameters over whole tables.

``QUERIES`` maps a key to a callable (spark, sf_dir); ``ORACLES`` holds DuckDB statements for
those that SQL expresses fast enough on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.llm import chat_format, decontaminate, fim, host_rules, jaccard_join, lz_dedup, packing, phrases, quality, separator_scan, suffix_dedup, url_filter, vector_join
from adoptlens.llm.tables import read, stored

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TOOL_SCHEMAS = {
    "search": {"text": ("STRING", True), "turn": ("BIGINT", True)},
    "summarise": {"text": ("STRING", True), "length": ("BIGINT", False)},
    "translate": {"text": ("STRING", True), "turn": ("BIGINT", True), "language": ("STRING", False)},
}


@query
def op1_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as a tool call that follows the one before, linked with the answer to it.

    The tables hold no tool calls, so they are derived: the tool from the text's length, the
    turn as text instead of a number in every tenth length.
    """
    turns = read(spark, sf_dir, "conversations")
    length = F.length("text")
    tool = F.element_at(F.array(*map(F.lit, sorted(TOOL_SCHEMAS))), (length % 3 + 1).cast("int"))
    right = F.to_json(F.struct("turn", "text"), {"ignoreNullFields": "false"})
    wrong = F.to_json(F.struct(F.col("turn").cast("string").alias("turn"), "text"), {"ignoreNullFields": "false"})
    calls = turns.where("role = 'user'").select(
        "conv_id", F.concat(F.lit("call_"), "turn").alias("call_id"), tool.alias("name"),
        F.when(length % 10 == 0, wrong).otherwise(right).alias("arguments"), F.concat(F.lit("call_"), F.col("turn") - 2).alias("after"))
    results = turns.where("role = 'assistant'").select("conv_id", F.concat(F.lit("call_"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return chat_format.link_every(calls, results, TOOL_SCHEMAS)


ORACLES["op1_tool_call_linking"] = """
WITH RECURSIVE u AS (
  SELECT conv_id, turn, ['search', 'summarise', 'translate'][length(text) % 3 + 1] AS name, length(text) % 10 = 0 AS odd, text
  FROM conversations WHERE role = 'user'),
d AS (
  SELECT conv_id, turn, 0 AS depth FROM u WHERE NOT EXISTS (SELECT 1 FROM u p WHERE p.conv_id = u.conv_id AND p.turn = u.turn - 2)
  UNION ALL
  SELECT u.conv_id, u.turn, d.depth + 1 FROM u JOIN d ON u.conv_id = d.conv_id AND u.turn = d.turn + 2),
r AS (SELECT conv_id, turn - 1 AS turn, text AS content FROM conversations WHERE role = 'assistant')
SELECT u.conv_id, 'call_' || u.turn AS call_id, name, CAST(depth AS BIGINT) AS depth,
       CASE WHEN odd AND name <> 'summarise' THEN 'turn is not BIGINT' END AS error,
       r.turn IS NOT NULL AS has_result,
       '{"arguments":{"text":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || CASE WHEN odd THEN '"' || u.turn || '"' ELSE CAST(u.turn AS VARCHAR) END
       || '},"content":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"id":"call_' || u.turn || '","name":"' || name || '"}' AS message
FROM u JOIN d USING (conv_id, turn) LEFT JOIN r ON r.conv_id = u.conv_id AND r.turn = u.turn
"""


@query
def op2_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a window of 13 repeats from a smaller one."""
    found = lz_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return found.select("doc_id", F.col("n_symbols").alias("n_words"), "n_removed", "kept_sha256")


@query
def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, read off flat files of all documents' ids."""
    end_id = 49407
    files = separator_scan.write_tokens(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id)
    return separator_scan.scan(stored(files, "token-files", compression="zstd"), end_id)


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    found = decontaminate.hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=13, share=20)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


ORACLES["op4_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
gram AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bw, range(1, len(w) - k + 2) AS t(i)),
ks AS (SELECT DISTINCT k FROM gram),
hit AS (
  SELECT r, i, k, g FROM (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
                          FROM d, ks, range(1, len(w) - k + 2) AS t(i)) SEMI JOIN gram USING (k, g)),
word AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
item AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS l FROM hit JOIN gram USING (k, g) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
"""


@query
def op5_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"), sample=3000)
    scored = quality.score(docs.select("doc_id", "text"), model, threshold=0.3)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


@query
def op6_gbt_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every url: the longest rule's, else the trees'."""
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES, sample=20_000)


@query
def op7_pivot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector by a cosine of at least 0.98 within its label."""
    found = vector_join.join(read(spark, sf_dir, "embeddings"), least=0.98)
    shown = vector_join.shown
    return found.withColumns({"vec_id": shown("vec"), "component_id": shown("component"), "kept": F.col("vec") == F.col("component")}).select("vec_id", "n_links", "component_id", "kept")


@query
def op8_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document by 4-word shingles of at least 85 in 100."""
    found = jaccard_join.classes(read(spark, sf_dir, "documents"), size=4, percent=85)
    shown = jaccard_join.visible_id
    return found.select(shown("doc").alias("doc_id"), F.col("n").alias("n_shingles"), shown("component").alias("component_id"))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a string of 50 repeats from a smaller one."""
    found = suffix_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    return found.select("doc_id", F.col("n_symbols").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op10_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op11_boundary_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two characters and rearranged; digests of it and of the text rebuilt from it."""
    done = fim.transform(read(spark, sf_dir, "documents").select("doc_id", "text"), seed="1", units="characters", plain=90, spm=20)
    digest = lambda c: F.sha2(c.cast("binary"), 256)  # noqa: E731
    return done.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"), digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLES["op11_boundary_fim"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, [CAST('0x' || s[8 * i + 1:8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM d),
c AS (SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query
def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; its source is its host."""
    return host_rules.judge(read(spark, sf_dir, "documents"), host="source", most=0.5).select("doc_id", *host_rules.MEASURES, "base_failed", "kept", "host_rate")


ORACLES["op12_host_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM documents),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) AS l FROM d),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times
      FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM d, range(1, len(w) - 1) AS t(i))),
m AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE times > 1) GROUP BY r),
e AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(m.n, 0) AS n_repeat_words
  FROM d JOIN l USING (r) LEFT JOIN m USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM e),
h AS (SELECT source, count(*) AS n, CAST(count(*) FILTER (base_failed) AS BIGINT) AS f FROM b WHERE source IS NOT NULL GROUP BY source),
q AS (SELECT count(*) AS k, CAST(sum(n) AS DOUBLE) AS total, CAST(sum(f) AS DOUBLE) AS bad, sum(CAST(f AS DOUBLE) * f / n) AS squares, sum(1.0 / n) AS inverse FROM h),
s AS (SELECT *, bad / total AS mean, CASE WHEN k > 1 THEN k * (squares - bad * bad / total) / ((k - 1) * total) END AS spread FROM q),
v AS (SELECT *, mean * (1 - mean) AS single, spread - mean * (1 - mean) * inverse / k AS between_ FROM s),
prior AS (SELECT mean, greatest(1.0, least(CASE WHEN between_ > 0 THEN (single - spread) / between_ ELSE total END, total)) AS weight FROM v),
rate AS (SELECT source, round((f + mean * weight) / (n + weight), 9) AS host_rate FROM h, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_rate > 0.5, FALSE) AS kept, host_rate
FROM b LEFT JOIN rate USING (source)
"""


@query
def op13_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return phrases.collocations(read(spark, sf_dir, "documents"), support=30, scale=2_000_000, contained=80, top=2000)


ORACLES["op13_son_collocations"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w
      FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?
-]')) AS piece FROM d)),
word AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
      FROM p, range(1, 5) AS s(k), range(1, len(w) - k + 2) AS t(i) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (
  SELECT c.lang, c.phrase, c.a, x.j, l.a AS l, r.a AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.a + r.a) AS BIGINT) AS score
  FROM c, range(1, c.k) AS x(j)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:x.j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[x.j + 1:], ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
           FROM c, range(1, k + 1) AS s(i), range(2, k) AS t(m) WHERE i + m - 1 <= k GROUP BY ALL),
left_ AS (SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase) WHERE NOT coalesce(100 * longer >= 80 * a, FALSE)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN word USING (lang) WHERE rank <= 2000
"""
