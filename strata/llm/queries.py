"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (bpe_codec, collocations, content_dedup, importance, leak_scan, line_dedup,
                        ordinal_quality, packing, quality_rules, simhash, suffix_dedup,
                        token_files, toxicity)
from strata.llm.common import read


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document; kept or not."""
    return ordinal_quality.grades(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                  ordinal_quality.graded_labels())


def op2_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return content_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the calibrated classifier's verdict."""
    out = quality_rules.rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.withColumn("probability", F.round("probability", 6))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back, per document."""
    return token_files.round_trip(read(spark, sf_dir, "documents"))


def op5_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components at two bits."""
    return simhash.near_groups(read(spark, sf_dir, "documents"))


def op6_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.pack(read(spark, sf_dir, "documents"))


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the chained categories; flagged or not."""
    return toxicity.score(read(spark, sf_dir, "documents"),
                          toxicity.categories(read(spark, sf_dir, "labels")),
                          ["toxic_prose", "toxic_junk", "toxic"])


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document, and what is left."""
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, and what is left."""
    return suffix_dedup.repeat_report(read(spark, sf_dir, "documents"))


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoded text."""
    return bpe_codec.encode_decode(read(spark, sf_dir, "documents"))


def op11_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights and scores of all documents against the benchmark's texts; the drawn tenth ranked."""
    return importance.draw_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_phrase_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a benchmark item's window covers."""
    return leak_scan.leak_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ordinal_quality, op2_content_sort_dedup, op3_quality_rules, op4_token_files,
        op5_simhash_ball, op6_window_packing, op7_toxicity_chain, op8_fuzzy_lines,
        op9_suffix_repeats, op10_bpe_tree, op11_importance_draw, op12_phrase_trees,
        op13_leak_scan)}

#: DuckDB SQL of the queries that SQL can express; models, tokenizers, XXH64 and
#: MinHash are tested against brute force or the library itself.
ORACLE = {
    "op2_content_sort_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
k AS (
  SELECT doc_id, body,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY size DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
""",
    "op9_suffix_repeats": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
late AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) AS least FROM win)
  WHERE doc_id > least),
gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS j FROM late),
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.j) AS text, count(*) AS n
  FROM words a ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.j = g.j GROUP BY a.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
    # CRC-32 byte by byte over the distinct words; every double is made as the query's
    "op11_importance_draw": r"""
WITH RECURSIVE
step(b, c, k) AS (
  SELECT b, b, 0 FROM (SELECT unnest(range(0, 256))::BIGINT AS b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM step WHERE k < 8),
crc AS (SELECT b, c FROM step WHERE k = 8),
d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
m AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
mw AS (SELECT unnest(w) AS word FROM m),
v AS (SELECT word, hex(encode(word)) AS x
      FROM (SELECT word FROM dw UNION SELECT word FROM mw)),
run(word, x, i, c) AS (
  SELECT word, x, 0, 4294967295::BIGINT FROM v
  UNION ALL
  SELECT word, x, i + 1,
         xor(crc.c, run.c >> 8)
  FROM run JOIN crc ON crc.b = xor(run.c, ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) & 255
  WHERE 2 * i < length(x)),
bucket AS (
  SELECT word, xor(c, 4294967295::BIGINT) % 10000 AS b FROM run WHERE 2 * i = length(x)),
s AS (SELECT b, count(*) AS n FROM dw JOIN bucket USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM mw JOIN bucket USING (word) GROUP BY b),
size AS (SELECT (SELECT count(*) FROM dw)::DOUBLE + 10000::DOUBLE AS alls,
                (SELECT count(*) FROM mw)::DOUBLE + 10000::DOUBLE AS allt),
gain AS (
  SELECT s.b, floor(1000::DOUBLE * ln((coalesce(t.n, 0)::DOUBLE + 1::DOUBLE) * alls
                                      / ((s.n::DOUBLE + 1::DOUBLE) * allt)))::BIGINT AS g
  FROM s LEFT JOIN t ON s.b = t.b CROSS JOIN size),
sums AS (
  SELECT doc_id, sum(g)::BIGINT AS total, count(*) AS n
  FROM dw JOIN bucket USING (word) JOIN gain USING (b) GROUP BY doc_id),
weighed AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
         CASE WHEN n IS NULL THEN 0
              ELSE (total - ((total % n) + n) % n) // n END::BIGINT AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN sums ON d.doc_id = sums.doc_id),
scored AS (
  SELECT doc_id, n_words, n_features, weight,
         (weight + floor(-1000::DOUBLE * ln(-ln((h::DOUBLE + 0.5::DOUBLE)
                                                / 4294967296::DOUBLE)))::BIGINT)::BIGINT AS score
  FROM weighed),
able AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored s LEFT JOIN able a ON s.doc_id = a.doc_id
""",
    "op12_phrase_trees": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
f AS (
  SELECT lang, k, w[i:i + k - 1] AS ws, count(*) AS n
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM p, (SELECT unnest(range(1, 5)) AS k))
  GROUP BY lang, k, w[i:i + k - 1]),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
able AS (SELECT lang, k, ws, n AS a FROM f WHERE k > 1 AND n >= 30),
cuts AS (
  SELECT c.lang, c.k, c.ws, c.a, j, x.n AS l, y.n AS r,
         ((2000000::HUGEINT * c.a) // (x.n::HUGEINT + y.n::HUGEINT))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM able) c
  JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:c.j]
  JOIN f y ON y.lang = c.lang AND y.ws = c.ws[c.j + 1:c.k]),
worst AS (
  SELECT lang, ws, a, l, r, score
  FROM (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) AS o FROM cuts)
  WHERE o = 1),
inside AS (
  SELECT lang, ws[i:i + m - 1] AS ws, max(a) AS most
  FROM (SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM able))
  GROUP BY lang, ws[i:i + m - 1]),
kept AS (
  SELECT w.lang, array_to_string(w.ws, ' ') AS phrase, a, l, r, score
  FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.ws = w.ws
  WHERE most IS NULL OR 100 * most < 80 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept)
SELECT k.lang, rank, phrase, a, l, r, t.n, score
FROM ranked k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
""",
    "op13_leak_scan": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
m AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS body
  FROM (SELECT item_id, w, least(10, len(w)) AS k,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM m WHERE len(w) > 0)),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS body
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM win))),
hit AS (SELECT doc_id, item_id, p.k, i FROM place p JOIN win ON p.k = win.k AND p.body = win.body),
words AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(item) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
       coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
""",
}
