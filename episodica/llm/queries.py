"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(_table(spark, sf_dir, "documents"))


def op2_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import extract

    return extract(_table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import byte_bpe

    return byte_bpe(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import decontaminate

    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_scan

    return secret_scan(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text (its remaining lines), n_lines and n_removed."""
    from .lines import line_dedup

    return line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), lines_col="n_lines", removed_col="n_removed")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .orc_ids import checked, read_token_files, write_token_files
    from .shared import shared_dir

    path = shared_dir(spark, "orc-ids")
    write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return checked(read_token_files(spark, path))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, identify

    docs = _table(spark, sf_dir, "documents")
    return identify(docs, fit(docs, share=None))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import filter_audit

    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_jaccard_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import importance_resample

    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), shortest=1, longest=1, buckets=10_000, percent=10, least_words=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: Windows of 10 words by unnesting; a shorter item is one window of its own length.
OP4_SQL = r"""
WITH dw AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS g
  FROM iw, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM dw, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(p) WHERE len(w) >= n),
found AS (SELECT o.doc_id, o.p, o.n, x.item_id FROM occ o JOIN win x ON o.n = x.n AND o.g = x.g),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM found, unnest(generate_series(p, p + n - 1)) AS t(q) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN names i ON i.doc_id = d.doc_id
"""


#: Sets by unnesting; texts of one set are one node; pairs meet at the shingles that two nodes have.
OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda p: array_to_string(w[p : p + 4], ' ')))) END AS grams FROM w),
d AS (SELECT doc_id, len(grams)::BIGINT AS n, sha256(array_to_string(grams, chr(10))) AS node, grams FROM s),
node AS (SELECT node, any_value(n) AS n, any_value(grams) AS grams, min(doc_id) AS least FROM d WHERE n > 0 GROUP BY node),
g AS (SELECT node, n, unnest(grams) AS gram FROM node),
few AS (SELECT * FROM g WHERE gram IN (SELECT gram FROM g GROUP BY gram HAVING count(*) > 1)),
link AS (
  SELECT x.node AS a, y.node AS b FROM few x JOIN few y ON x.gram = y.gram AND x.node <> y.node AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
  GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (SELECT node AS a, node AS b FROM node UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
named AS (SELECT r.a AS node, min(n.least) AS component_id FROM reach r JOIN node n ON n.node = r.b GROUP BY r.a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id FROM d LEFT JOIN named m ON m.node = d.node AND d.n > 0
"""


#: The mask of a document's failures by part and labels, and every order of the five letters.
OP11_SQL = r"""
WITH label AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
least AS (SELECT coalesce(text, '') AS text, min(doc_id) AS least FROM documents GROUP BY 1),
d AS (
  SELECT coalesce(d.lang, '') AS part, regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(d.text, '') AS text,
    coalesce(b.good, false) AS good, coalesce(b.toxic, false) AS toxic, coalesce(x.least < d.doc_id, false) AS copy
  FROM documents d LEFT JOIN label b ON b.doc_id = d.doc_id LEFT JOIN least x ON x.text = coalesce(d.text, '')),
f AS (
  SELECT part, good, toxic, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'), copy] AS fails FROM d),
p AS (SELECT 'A' AS c UNION ALL SELECT 'B' UNION ALL SELECT 'C' UNION ALL SELECT 'D' UNION ALL SELECT 'E'),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM p a, p b, p c, p d, p e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, ascii(filter_order[step::INTEGER]) - 64 AS i,
    list_transform(range(1, step), lambda k: ascii(filter_order[k::INTEGER]) - 64) AS before FROM o, range(1, 6) AS r(step)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
x AS (
  SELECT part, filter_order, step, i, n, good, toxic, fails[i] AS bad, list_bool_or(list_transform(before, lambda k: fails[k])) AS gone,
    len(list_filter(fails, lambda y: y)) = 1 AS alone FROM g, steps),
r AS (
  SELECT part, filter_order, step, i, coalesce(sum(n) FILTER (NOT bad AND NOT coalesce(gone, false)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (bad AND NOT coalesce(gone, false)), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (bad AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (bad AND alone), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (bad AND NOT coalesce(gone, false)), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (bad AND NOT coalesce(gone, false)), 0)::BIGINT AS toxic_lost FROM x GROUP BY ALL)
SELECT * EXCLUDE (i), sum(removed) OVER (PARTITION BY part, i)::BIGINT AS shapley FROM r
"""

#: CRC32 by its table, made by the rule, over the UTF-8 bytes of each distinct word.
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
bw AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
tab AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
bytes AS (SELECT w, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM words),
crc AS (
  SELECT w, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM dw) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM bw) + 10000))))::BIGINT AS gain
  FROM range(10000) AS r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weight AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM dw JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
score AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN weight USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM score WHERE n_features >= 20)
SELECT s.*, CASE WHEN r.rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN r.rank END AS rank FROM score s LEFT JOIN ranked r USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_winnowing": OP4_SQL, "op11_filter_audit": OP11_SQL, "op12_jaccard_trie": OP12_SQL, "op13_resample": OP13_SQL}
