import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from adit.llm.token_files import TOGETHER, Encoder, PerfectHash, find_documents, token_digests, write_token_files
from adit.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 20000):
        keys = np.random.default_rng(n).choice(1 << 60, n, replace=False) - (1 << 59)
        slots = PerfectHash.build(keys).slots(keys)
        assert sorted(slots.tolist()) == list(range(n))


@pytest.mark.parametrize("shard_bytes", [1 << 20, 1])
def test_files_hold_the_library_s_ids(spark, table, corpus, shard_bytes):
    rows = [*corpus, (950, "a <|endoftext|> b\u3000c it's ΑΣ e\u0301"), (0, "same id, other text")]
    manifest = write_token_files(table(rows), scratch_path(spark, "ids"), PATH, 1, shard_bytes=shard_bytes)
    got = [tuple(r) for r in token_digests(manifest).collect()]
    tok = Tokenizer.from_file(PATH)
    ids = lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 1]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    key = lambda i: -1 if i is None else i
    assert sorted((key(i), n, c) for i, _, n, c in got) == sorted((key(i), len(ids(t)), crc(ids(t))) for i, t in rows)
    start = 0
    for i, s, n, _ in sorted(got, key=lambda r: r[1]):
        assert s == start
        start += n
    assert [key(r[0]) for r in sorted(got, key=lambda r: r[1])] == sorted(key(i) for i, _ in rows)
    found = find_documents(manifest, spark.createDataFrame([(0,), (950,), (5555,), (None,)], "doc_id long")).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in found) == sorted((i, ids(t)) for i, t in rows if i in (0, 950))


def test_words_encoded_together_have_the_ids_of_words_alone():
    """Marks that compose or change places, characters of many bytes, special tokens and blanks that part no words."""
    signs = ["a", "B", "e\u0301", "\u0301", "\u0315", "\u0300", "\u1100", "\u1161", "\u200d", "\U0001f469", "\u00df", "\u0130", "\u03a3", "\u3000", "\u00a0", "\x1c", "\x00", "'s", "7", "_", "<|endoftext|>", "<|startoftext|>"]
    rnd, encoder = random.Random(4), Encoder(PATH, 1)
    words = list(dict.fromkeys("".join(rnd.choices(signs, k=rnd.randint(1, 6))) for _ in range(3 * TOGETHER)))
    alone = [np.array(e.ids, encoder.kind).tobytes() for e in Tokenizer.from_file(PATH).encode_batch(words, add_special_tokens=False)]
    assert encoder.encoded(words) == alone
    calls, encode = [], encoder.tokenizer.encode

    class Counted:
        def encode(self, text, **options):
            calls.append(text)
            return encode(text, **options)

    encoder.tokenizer = Counted()
    ids, ends = encoder.ids(pa.array([" ".join(words), None, words[0]]))
    assert ids.tobytes() == b"".join([*alone, encoder.end, encoder.end, alone[0], encoder.end]) and len(ends) == 3
    assert 0 < len(calls) <= len(words) // TOGETHER + 1


def test_empty_table(spark, table):
    assert token_digests(write_token_files(table([]), scratch_path(spark, "ids"), PATH, 1)).collect() == []
