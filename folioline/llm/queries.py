"""The registered queries of this folder, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioline.llm import (
    alignment as token_alignment, chats, decontaminate as decontamination, extract, licenses, near_join, negatives as hard_negatives, paragraphs, pieces,
    mil as quality_mil, quality as quality_rules, substrings, toxicity as toxic_scores)

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return register


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraphs.repeated_paragraphs(_read(spark, sf_dir, "documents"), across_lines=True)
    # short lines, which many documents share, are counted apart
    n_long = F.size("removed").cast("long") - F.col("n_short") + F.size("passages").cast("long")
    return found.select("doc_id", "n_paragraphs", n_long.alias("n_removed"), "removed", F.col("n_short").alias("n_short_removed"), "passages")


@query("op2_html_extraction")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_read(spark, sf_dir, "pages"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_bigrams(column: str) -> str:
    words = f"list_filter(string_split_regex(lower({column}), '[^0-9a-z]+'), lambda x: x <> '')"
    return (f"list_distinct(CASE WHEN len({words}) = 1 THEN {words} ELSE list_transform(range(1, len({words})), "
            f"lambda i: ({words})[i] || ' ' || ({words})[i + 1]) END)")


OP3_SQL = f"""
WITH t AS (SELECT DISTINCT license, {_sql_bigrams('template')} AS tb FROM (VALUES {', '.join(
    f'({_sql_text(a)}, {_sql_text(b)})' for a, b in licenses.NOTICES)}) AS v(license, template)),
l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
n AS (SELECT doc_id, i, lower(line) AS line FROM l
      WHERE len(string_split_regex(lower(line), '[^0-9a-z]+')) BETWEEN 1 AND 100),
b AS (SELECT doc_id, i, {_sql_bigrams('line')} AS lb FROM n),
p AS (SELECT doc_id, i, license, 2.0::DOUBLE * len(list_intersect(lb, tb)) / (len(lb) + len(tb)) AS dice
      FROM b JOIN t ON len(lb) > 0 AND 2 * least(len(lb), len(tb)) >= 0.8 * (len(lb) + len(tb))),
m AS (SELECT doc_id, count(DISTINCT i) AS n_lines, min((-dice, license)) AS best FROM p WHERE dice >= 0.8 GROUP BY doc_id)
SELECT d.doc_id, best[2] AS license, -best[1] AS dice, coalesce(n_lines, 0) AS n_lines FROM documents d LEFT JOIN m USING (doc_id)
"""


@query("op3_license_scan", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"), licenses.templates(spark))


#: Where the public vocabularies are; a parameter of the operator.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode_and_check(docs, pieces.load_vocabulary(PIECES), marks_as_spaces=False)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "round_trip")


_SPARK_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

OP5_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPARK_WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(
      range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
r AS (SELECT doc_id, n, x FROM t WHERE x IN (SELECT x FROM t GROUP BY x HAVING count(*) > 1)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS k FROM r a JOIN r b
      ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * k >= 80 * (an + bn - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN c USING (doc_id)
"""


@query("op5_ngram_jaccard_join", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_copies(_read(spark, sf_dir, "documents")).drop("component")


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 49)) AS p, h FROM d WHERE len(h) >= 100),
g AS (SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS s FROM w),
f AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT g.doc_id, p, lag(p) OVER (PARTITION BY g.doc_id ORDER BY p) AS q FROM g JOIN f USING (s) WHERE g.doc_id > least),
k AS (SELECT doc_id, p, sum(CASE WHEN p <= q + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM r),
x AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM k GROUP BY doc_id, k),
y AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n FROM x GROUP BY doc_id),
z AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM x
      UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(len(h)) // 2 FROM d LEFT JOIN x USING (doc_id) GROUP BY d.doc_id),
t AS (SELECT doc_id, string_agg(substring(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS left_over FROM z JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(left_over)) AS kept_sha256
FROM d JOIN t USING (doc_id) LEFT JOIN y USING (doc_id)
"""


@query("op6_suffix_array_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_report(_read(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.quality(docs)


OP8_SQL = """
WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, sha256(text)) AS pos FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list((role, text) ORDER BY pos) AS turns FROM t GROUP BY conv_id),
p AS (SELECT c.conv_id, q.pos AS k, hash(c.turns[1:q.pos]) AS h FROM c JOIN t q USING (conv_id)),
e AS (SELECT conv_id, n, hash(turns) AS h FROM c),
u AS (SELECT min(conv_id) AS conv_id FROM e GROUP BY n, h),
keep AS (SELECT conv_id FROM u JOIN e USING (conv_id) WHERE NOT EXISTS (
    SELECT 1 FROM p JOIN c USING (conv_id) WHERE p.k = e.n AND p.h = e.h AND c.n > e.n))
SELECT conv_id, CAST(floor((pos - 1) / 256) AS BIGINT) AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM t JOIN keep USING (conv_id) GROUP BY ALL
"""


@query("op8_chat_formatting", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(_read(spark, sf_dir, "conversations"))


_DOC_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_DOC_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_DOC_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p, w FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM iw),
widths AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM d, widths WHERE len(w) >= k),
occ AS (SELECT DISTINCT dw.doc_id, dw.p, dw.k, win.item_id FROM dw JOIN win
        ON dw.k = win.k AND array_to_string(dw.w[dw.p:dw.p + dw.k - 1], ' ') = win.s),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM
        (SELECT doc_id, unnest(range(p, p + k)) AS q FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h
        FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op9_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.decontaminate(docs, _read(spark, sf_dir, "benchmark")).drop("text_key")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_scores.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


OP11_SQL = """
WITH v AS (SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR NOT abs(CAST(x AS DOUBLE)) < 65536)) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS al, r.vec_id AS id, r.label AS rl,
             CAST(coalesce(list_sum(list_transform(range(1, least(len(a.e), len(r.e)) + 1), lambda i: a.e[i] * r.e[i])), 0) AS BIGINT) AS score
      FROM a JOIN v r ON r.vec_id <> a.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score, al FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE rl = al) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.rl <> p.al
        AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_read(spark, sf_dir, "embeddings"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(_read(spark, sf_dir, "documents"))


@query("op12_quality_classifier")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
