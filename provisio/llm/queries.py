"""The registered queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op9_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    from provisio.llm.packing import best_fit_packing

    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from provisio.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    from provisio.llm.language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a window of a benchmark item."""
    from provisio.llm.decontaminate import report

    found = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


ORACLE["op1_decontaminate"] = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bs AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM bs)),
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
h AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.size = bw.size),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY 1),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@query
def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted as a prefix tree and read back."""
    from provisio.llm.chat_tree import read_back, tree

    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    columns = ("conv_id", "turn", "role", "text")
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    nodes, whole = tree(table(spark, sf_dir, "conversations", *columns).unionAll(extra), path)
    return read_back(nodes, whole, path)


ORACLE["op4_chat_tree"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, regexp_replace(replace(role, '\', '\\'), '(<)(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|startoftext\|>|\|endoftext\|>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g') AS er,
         regexp_replace(replace(text, '\', '\\'), '(<)(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|startoftext\|>|\|endoftext\|>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g') AS et
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + 23) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License templates that each document holds."""
    from provisio.llm.licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents")).select("doc_id", "license", "containment")


def _license_sql() -> str:
    from provisio.llm.licenses import TEMPLATES

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))
    return rf"""
WITH t0(license, text) AS (VALUES {rows}),
tw AS (SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM t0),
ts AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM tw)),
tn AS (SELECT license, count(*) AS m, greatest(2, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT)) AS c FROM ts GROUP BY 1),
d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT doc_id, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
h AS (SELECT doc_id, license, m, g, unnest([p // c, p // c - 1]) AS win FROM ds JOIN ts USING (g) JOIN tn USING (license)),
n AS (SELECT doc_id, license, win, count(DISTINCT g) / max(m) AS share FROM h WHERE win >= 0 OR win = -1 GROUP BY 1, 2, 3)
SELECT doc_id, license, max(share) AS containment FROM n WHERE win >= 0 AND share >= 0.75 GROUP BY 1, 2
"""


ORACLE["op10_license_scan"] = _license_sql()


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that repeat."""
    from provisio.llm.substrings import dedup

    return dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op5_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win WHERE g IN (SELECT g FROM again)),
word AS (SELECT r, p, w[p] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM word WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.r = word.r AND gone.p = word.p)
  GROUP BY r),
n AS (SELECT r, count(*) AS n_removed FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN kept ON d.r = kept.r
"""


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are similar."""
    from provisio.llm.jaccard import similar

    return similar(table(spark, sf_dir, "documents"))


ORACLE["op6_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 75 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.c, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) m ON d.doc_id = m.a
"""


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near neighbours of all embeddings of equal label."""
    from provisio.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are near copies of an earlier line."""
    from provisio.llm.lines import dedup_lines

    found = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), counts=True)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    from provisio.llm.token_alignment import alignment

    return alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and perplexity verdict of every document."""
    from provisio.llm.perplexity import quality

    return quality(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their commonest near word and its root."""
    from provisio.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


ORACLE["op11_spelling_variants"] = r"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(3988292384, x // 2) ELSE x // 2 END, b)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
coded AS (
  SELECT run, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)) AS b
  FROM runs WHERE length(run) >= 7),
crc AS (
  SELECT run, xor(4294967295, list_reduce(list_transform(b, lambda v: CAST(v AS BIGINT)), lambda x, y: xor(t[xor(x & 255, y) + 1], x // 256), 4294967295)) AS h
  FROM coded, bits),
res AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM crc),
w AS (SELECT word, count(*) AS n FROM res WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2),
cut AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS v FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word AS word, b.word AS other, b.n AS n FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.v = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS form_n FROM near GROUP BY 1),
form AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 10 * w.n THEN b.form_n END AS form_n,
         CASE WHEN b.form_n >= 10 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.n = b.form_n) END AS form
  FROM w LEFT JOIN best b ON w.word = b.word),
way(word, spot, step) AS (
  SELECT word, form, 1 FROM form WHERE form IS NOT NULL
  UNION ALL SELECT way.word, form.form, step + 1 FROM way JOIN form ON way.spot = form.word WHERE form.form IS NOT NULL),
root AS (SELECT word, arg_max(spot, step) AS root FROM way GROUP BY 1)
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM form f LEFT JOIN root r ON f.word = r.word
"""
