import re

import pytest
import xxhash

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage over a small table."""
    from adit.session import materialize

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in p.STAGES:
        after = materialize(stage(spark, docs, SF), f"test-{name}")
        out.append((docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def test_columns_and_names(stages):
    assert [n for n, _ in p.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "pieces"]
    for before, after, columns, new in stages[:4]:
        assert columns == new and 0 < len(after) <= len(before)


def test_quality_keeps_what_scores(stages, spark):
    before, after, *_ = stages[0]
    kept = {r.doc_id for r in after}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.9
    assert {r.doc_id: r.text for r in before if r.doc_id in kept} == {r.doc_id: r.text for r in after}


def test_line_dedup_leaves_each_line_once(stages):
    before, after, *_ = stages[1]
    lines = [x for r in after for x in r.text.split("\n") if len(x) >= 20]
    assert len(lines) == len(set(lines))
    gone = {x for r in before for x in r.text.split("\n") if len(x) >= 20} - set(lines)
    assert all(any(abs(len(a) - len(b)) <= 1 for b in lines) for a in gone)
    assert all(r.n_chars == len(r.text) for r in after)


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_dedup_against_all_pairs(spark, stages):
    """Exact copies, copies with a few words changed, equal and missing ids, texts without words, and all else."""
    base = [r for r in stages[0][0] if len(r.text.split()) >= 60][:60]
    rows = [(r.doc_id, r.text) for r in base]
    for k, r in enumerate(base[:40]):
        words = r.text.split(" ")
        for at in range(7, len(words), max(60, len(words) // (1 + k % 3))):
            words[at] = "replaced"
        rows.append((10_000 + k, " ".join(words)))
    rows += [(20_000 + k, r.text) for k, r in enumerate(base[:5])] + [(20_000, base[0].text), (None, base[1].text), (None, "alone and without any id"), (30_000, None), (30_001, ""), (30_002, None), (30_000, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id int, row long")
    after = p.near_dedup(spark, docs, SF)
    kept = after.collect()
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    first = {}
    for g, (i, _) in zip(group, rows, strict=True):
        first[g] = min(first.get(g, (True, 0)), (i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(first.values())
    assert len(kept) < len(rows) and after.columns == docs.columns
    assert {(r.doc_id, r.text) for r in kept} <= set(rows)


def test_decontamination(stages, spark):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = lambda w: {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    test = set().union(*(windows(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()))
    before, after, *_ = stages[3]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not windows(words(r.text)) & test}


def test_pieces_decode_to_the_texts(stages):
    before, after, *_ = stages[4]
    assert {r.doc_id: r.text for r in after} == {r.doc_id: r.text for r in before} and all(r.exact and r.n_pieces == len(r.ids) for r in after)


def test_run_is_the_stages(spark, stages):
    assert sorted(r.doc_id for r in p.run(spark, SF).collect()) == sorted(r.doc_id for r in stages[4][1])


def test_extra_columns_of_any_name_pass_every_stage(spark, stages):
    names = ["key", "row", "c0", "document", "doc", "print", "gone", "lines", "n_lines", "n_removed", "n_links", "kept_text", "quality_score", "score", "fingerprint", "component_id", "n_hit", "items", "a.b"]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, *range(len(names))) for r in stages[0][0][:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        kept = after.collect()
        assert kept and all([r[n] for n in names] == list(range(len(names))) for r in kept), name
        assert sorted((r.doc_id, r.text, r.n_chars) for r in kept) == sorted((r.doc_id, r.text, r.n_chars) for r in stage(spark, plain, SF).collect()), name


def test_every_stage_takes_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (None, "x", "en", "s", 1), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "word " * 20000, "en", "s", 100000)]
    for rows in ([], odd):
        for _, stage in p.STAGES:
            assert len(stage(spark, spark.createDataFrame(rows, schema), SF).collect()) <= len(rows)
