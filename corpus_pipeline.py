"""From documents to encoded training texts: quality, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that it is given, and gives a frame; run() writes each stage's frame to
the shared folder and reads it again as the next one's documents. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from adit.llm.base import load
from adit.llm.decontaminate import decontaminate
from adit.llm.lines import dedup_lines
from adit.llm.pieces import round_trip
from adit.llm.quality import THRESHOLD, held_out, score, train
from adit.llm.simhash import near_duplicates
from adit.session import materialize


def numbered(docs: DataFrame) -> DataFrame:
    """The frame with its columns named c0, c1 and so on, so that no name of theirs meets one of an operator."""
    return docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])


def named(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `numbered` under their names again."""
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def place(docs: DataFrame, column: str) -> str:
    return f"c{docs.columns.index(column)}"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good, learnt from the labels that are not held out.

    Null and empty texts are scored like others. Equal texts have one fate; rows that repeat stay repeated.
    """
    model = train(docs, load(spark, sf_dir, "labels").where(~held_out()))
    scored = score(numbered(docs), model, text=place(docs, "text"), score_column="quality_score")
    return named(scored.where(F.col("quality_score") >= THRESHOLD), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier, alike or but for one edit. One that keeps nothing of what it had goes.

    Null, empty and blank texts stay as they are, as they lose nothing. Rows equal in id and text stand for one document and keep the same lines;
    null ids come first. n_chars is counted anew where lines went.
    """
    text, n_chars = place(docs, "text"), place(docs, "n_chars")
    kept = dedup_lines(numbered(docs), 1, 20, text, place(docs, "doc_id"))
    left = kept.where((F.col("n_removed") == 0) | (F.trim(F.translate("kept_text", "\n\r\t", "   ")) != ""))
    counted = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col(n_chars)).cast(docs.schema["n_chars"].dataType)
    return named(left.withColumns({n_chars: counted, text: F.col("kept_text")}), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that four bits or fewer link: fingerprints of four-word shingles, as in op1.

    The smallest doc_id of a group stays, one without an id only if the group has no other; of rows that share it, one. Texts
    without words (null, empty, blank) have the fingerprint zero and are one group.
    """
    rows = materialize(numbered(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    doc_id = F.col(place(docs, "doc_id"))
    order = F.struct(doc_id.isNull().alias("without"), doc_id.alias("doc_id"), "row")
    found = near_duplicates(rows.select(order.alias("key"), F.col(place(docs, "text")).alias("text")), 4, 4, 42, id_column="key")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id.row").alias("row"))
    return named(rows.join(gone, "row", "left_anti"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item, items without an id included.

    Null and empty texts stay. Rows equal in id and text have one fate, and rows that repeat stay repeated.
    """
    text = place(docs, "text")
    keyed = numbered(docs).withColumn("key", F.xxhash64(place(docs, "doc_id"), text))
    found = decontaminate(keyed, load(spark, sf_dir, "benchmark"), 10, text=text, id_column="key")
    bad = materialize(found.where("n_hit > 0").select(F.col("doc_id").alias("key")).distinct(), "contaminated")
    return named(keyed.join(bad, "key", "left_anti"), docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and scores of every document's three best segmentations (the second and third by what differs), whether each decodes to the text, and the text of the best.

    A row for each document, rows that repeat and null ids included. Null and empty texts have no ids and decode to the empty text.
    """
    encoded = round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), 3, with_ids=True)
    return encoded.select("doc_id", "ids", "n_pieces", "score", "scores", F.col("decoded").alias("text"), "exact", "rank_changes", "rank_pieces", "rank_crc32", "rank_exact")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pieces", pieces)]
#: SQL can't express the classifier, the fingerprints or the segmentations; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
