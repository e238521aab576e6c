"""Every operator on odd rows, with extra columns that are named like anything it uses, and on empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from adit.llm.conversations import damage, repair
from adit.llm.decontaminate import decontaminate
from adit.llm.graph_search import search_all
from adit.llm.lines import dedup_lines
from adit.llm.lm import lm_scores
from adit.llm.personal import Model, find_personal
from adit.llm.pieces import round_trip
from adit.llm.quality import classify
from adit.llm.repeats import remove_repeats
from adit.llm.simhash import near_duplicates
from adit.llm.token_counts import count_tokens
from adit.llm.token_files import token_digests, write_token_files
from adit.llm.whitening import whiten
from adit.session import scratch_path

NAMES = (
    "id key print part seq row doc place line first gone h g n n_words n_removed n_hit n_lines n_links items shard number begins ends fingerprint component_id root node a b "
    "vector label ids dim slice range block component whitened score kept_text decoded spans base_spans wide kind start again same turns code conv present idx audit x c0"
).split()

TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "word " * 3000), (5, "the same text stands here twice, a@b.org +1 (200) 555-0100"), (5, "the same text stands here twice, a@b.org +1 (200) 555-0100")]
TEXTS += [(None, "no id at all but a text of some length, you see"), (6, "no id at all but a text of some length, you see"), (7, "über 𝔸 — ünd\x00 odd   signs"), (50, "one line that is long enough\none line that is long enough")]
VECTORS = [(0, [1.0, 2.0, 0.5]), (50, [1.0, 2.0, 0.5]), (50, [3.0, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (3, None), (4, []), (5, [None, 1.0, 2.0]), (6, [float("nan")] * 3), (7, [0.0, 0.0, 0.0]), (8, [2.0, 2.0, 9.0]), (9, [1.0])]
TURNS = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", None), (2, None, None, None), (None, 3, "", ""), (3, 5, "system", "long " * 9000), (3, 9, "user", " ?")]


def tables(spark, extra, empty):
    names = [f"{c} int" for c in extra]
    make = lambda rows, columns: spark.createDataFrame([(*r, *range(len(names))) for r in ([] if empty else rows)], ", ".join([columns, *[n for n in names if f" {n.split()[0]} " not in f" {columns.replace(',', ' ')} "]]))
    return {
        "documents": make(TEXTS, "doc_id long, text string"),
        "embeddings": make(VECTORS, "vec_id long, embedding array<float>"),
        "conversations": make(TURNS, "conv_id long, turn long, role string, text string"),
        "labels": make([(2, 0), (3, 1), (4, None), (None, 1), (5, 1), (6, 0)], "doc_id long, quality int"),
        "benchmark": make([(1, "the same text"), (None, "no id at all"), (2, None), (3, ""), (3, "the same text")], "item_id long, text string"),
    }


WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
MODEL = Model(0.5, ((1, 9, (2, 5, -1.0, 1.0), (3, 1, 0.5, 2.0)),), (0.5, None, 0.9, 0.6))
OPERATORS = {
    "op1": lambda s, t: near_duplicates(t["documents"]),
    "op2": lambda s, t: search_all(t["embeddings"], 50, 5),
    "op3": lambda s, t: count_tokens(t["documents"], WORD),
    "op4": lambda s, t: token_digests(write_token_files(t["documents"], scratch_path(s, "ids"), WORD, 1)),
    "op5": lambda s, t: classify(t["documents"], t["labels"]),
    "op6": lambda s, t: decontaminate(t["documents"], t["benchmark"], 3, 1),
    "op7": lambda s, t: round_trip(t["documents"], PIECE, 3),
    "op8": lambda s, t: lm_scores(t["documents"], 3),
    "op9": lambda s, t: remove_repeats(t["documents"], 4),
    "op10": lambda s, t: dedup_lines(t["documents"], 1, 10),
    "op11": lambda s, t: find_personal(t["documents"], MODEL).select("doc_id", "base_spans", "spans"),
    "op12": lambda s, t: whiten(t["embeddings"]).withColumn("whitened", F.round(F.abs("whitened"), 6)),
    "op13": lambda s, t: repair(damage(t["conversations"]), F.col("present")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_extra_columns_change_nothing(spark, name):
    run = OPERATORS[name]
    plain = run(spark, tables(spark, [], False))
    crowded = run(spark, tables(spark, [n for n in NAMES if n not in plain.columns or name != "op10"], False)).select(*plain.columns)
    rows = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
    got = rows(plain)
    assert got and rows(crowded) == got
    if name not in ("op2", "op12", "op13"):
        assert len(got) == len(TEXTS)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark, tables(spark, NAMES[:5], True)).collect() == []
