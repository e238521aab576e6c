"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from adit.llm.base import QUERIES, load, query  # noqa: F401
from adit.llm.conversations import damage, repair
from adit.llm.decontaminate import decontaminate
from adit.llm.graph_search import search_all
from adit.llm.lines import dedup_lines
from adit.llm.lm import lm_scores
from adit.llm.personal import KINDS, count_of, find_personal, train as train_personal, written
from adit.llm.pieces import round_trip
from adit.llm.quality import classify
from adit.llm.repeats import remove_repeats
from adit.llm.simhash import near_duplicates
from adit.llm.token_counts import count_tokens
from adit.llm.token_files import token_digests, write_token_files
from adit.llm.whitening import whiten
from adit.session import scratch_path


@query("op1_simhash")
def op1(spark, sf_dir):
    """Every document with its fingerprint and the smallest document it is linked to."""
    found = near_duplicates(load(spark, sf_dir, "documents"), 4, 4, 42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_nearest")
def op2(spark, sf_dir):
    """The five nearest rows of every fiftieth vector, among all vectors."""
    return search_all(load(spark, sf_dir, "embeddings"), 50, 5)


@query("op3_token_counts")
def op3(spark, sf_dir):
    """Greedy word-piece counts of every document."""
    return count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_token_files")
def op4(spark, sf_dir):
    """Every document's ids, written to shard files and read back."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_digests(write_token_files(load(spark, sf_dir, "documents"), scratch_path(spark, "token-files"), tokenizer, 1))


@query("op5_quality")
def op5(spark, sf_dir):
    """Every document's quality score, learnt from the rows that are not held out."""
    return classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op7_pieces")
def op7(spark, sf_dir):
    """Every document's three best segmentations, and whether the best decodes to the document."""
    found = round_trip(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 3)
    return found.withColumn("decoded", F.sha2("decoded", 256)).withColumnRenamed("decoded", "decoded_sha256")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT sum(len(w)) AS n FROM d),
p AS (SELECT row, len(w) AS size, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (
  SELECT row, i, size, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2,
    CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3, CASE WHEN i > 1 THEN w[i - 1] END AS c1,
    CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS c2
  FROM p),
c AS (
  SELECT *, count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, row) AS n1,
    CASE WHEN g2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, row) END AS n2,
    CASE WHEN g3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, row) END AS n3
  FROM g),
k AS (SELECT *, lag(n1) OVER (PARTITION BY row ORDER BY i) AS k1, lag(n2) OVER (PARTITION BY row ORDER BY i) AS k2 FROM c),
s AS (
  SELECT row, CASE
    WHEN n3 > 0 THEN ln(n3 / k2)
    WHEN n2 > 0 THEN ln(n2 / k1) + CASE WHEN g3 IS NULL THEN 0 ELSE ln(0.4) END
    ELSE (CASE WHEN n1 > 0 THEN ln(n1 / (n - size)) ELSE ln(1 / (n - size + 1)) END)
      + CASE WHEN g2 IS NULL THEN 0 ELSE ln(0.4) END + CASE WHEN g3 IS NULL THEN 0 ELSE ln(0.4) END END AS x
  FROM k, n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(sum(x), 0), 3) AS log_score, round(sum(x) / len(w), 6) AS mean_log_score
FROM d LEFT JOIN s USING (row) GROUP BY row, doc_id, len(w)
"""


@query("op8_lm_scores", OP8_SQL)
def op8(spark, sf_dir):
    """Every document's trigram score under the rest of the corpus."""
    found = lm_scores(load(spark, sf_dir, "documents"), 3)
    return found.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM s),
again AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM g WHERE h IN (SELECT h FROM again)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op9_substring_dedup", OP9_SQL)
def op9(spark, sf_dir):
    """Every document without the passages of 35 words or more that repeat."""
    kept = remove_repeats(load(spark, sf_dir, "documents"), 35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS p FROM bw),
d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
lengths AS (SELECT DISTINCT n FROM phrases),
dw AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
g AS (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM dw),
hit AS (SELECT row, n, i, item_id FROM g JOIN phrases USING (n, p)),
found AS (SELECT row, string_agg(s, ',' ORDER BY s) AS items, count(*) AS n_items FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY row),
marked AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT row, n, i FROM hit)) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN found USING (row) LEFT JOIN marked USING (row)
"""


@query("op6_decontamination", OP6_SQL)
def op6(spark, sf_dir):
    """Every document's words inside ten-word windows of benchmark items."""
    found = decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT row, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
t AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS nth FROM l WHERE length(line) >= 20),
c AS (SELECT line, length(line) AS n, doc_id, i FROM t WHERE nth = 1),
k AS (
  SELECT a.line, b.doc_id AS other_doc, b.i AS other_i, a.doc_id, a.i
  FROM (SELECT *, unnest([n - 1, n, n + 1]) AS m FROM c) a JOIN c b ON a.m = b.n
  WHERE a.line <> b.line AND (left(a.line, a.n // 2 - 1) = left(b.line, a.n // 2 - 1) OR right(a.line, a.n // 2 - 1) = right(b.line, a.n // 2 - 1))
    AND levenshtein(a.line, b.line) <= 1),
links AS (SELECT line, count(*) AS links, bool_or((other_doc, other_i) < (doc_id, i)) AS near FROM k GROUP BY line),
m AS (
  SELECT l.row, l.i, coalesce(links, 0) AS links, coalesce(nth > 1 OR near, false) AS gone, l.line
  FROM l LEFT JOIN t ON l.row = t.row AND l.i = t.i LEFT JOIN links ON t.line = links.line)
SELECT doc_id, CAST(count(i) AS BIGINT) AS n_lines, CAST(count(i) FILTER (gone) AS BIGINT) AS n_removed, CAST(coalesce(sum(links), 0) AS BIGINT) AS n_links,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN m USING (row) GROUP BY row, doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark, sf_dir):
    """Every document without lines that stand earlier, alike or but for one edit."""
    kept = dedup_lines(load(spark, sf_dir, "documents"), 1, 20)
    return kept.select("doc_id", "n_lines", "n_removed", "n_links", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query("op11_personal")
def op11(spark, sf_dir):
    """Every document's personal data: base spans counted and hashed, and all spans."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal(docs, train_personal(docs))
    counts = [count_of(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query("op12_whitening")
def op12(spark, sf_dir):
    """Every vector on the sixteen leading components, each of unit spread."""
    return whiten(load(spark, sf_dir, "embeddings"))


@query("op13_conversations")
def op13(spark, sf_dir):
    """Every damaged conversation's faults and the cheapest edits that repair it."""
    return repair(damage(load(spark, sf_dir, "conversations")), F.col("present"))
