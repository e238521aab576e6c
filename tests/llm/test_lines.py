import random

import pytest
from pyspark.sql import functions as F

from adit.llm.lines import dedup_lines, within


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(left + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def changed(rnd, s, n):
    s = list(s)
    for _ in range(n):
        k = rnd.randrange(len(s) + 1)
        s[k : k + rnd.choice([0, 1])] = rnd.choice(["", "x", "é", "a"])
    return "".join(s)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_bit_parallel_distance(spark, distance):
    rnd = random.Random(distance)
    rows = [(a := "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 14))), changed(rnd, a, rnd.randint(0, 5))) for _ in range(400)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", within(F.col("a"), F.col("b"), distance).alias("x")).collect()
    assert [r for r in got if r.x != (edits(r.a, r.b) <= distance)] == []


def brute(rows, distance, least):
    order = sorted((i if i is not None else float("-inf"), k) for k, (i, _) in enumerate(rows))
    first, near = {}, {}
    for i, k in order:
        for p, line in enumerate((rows[k][1] or "").split("\n")):
            if len(line) >= least:
                first.setdefault(line, (i, p))
    names = list(first)
    links = {a: [b for b in names if a != b and abs(len(a) - len(b)) <= distance and edits(a, b) <= distance] for a in names}
    out = []
    for i, text in rows:
        lines = text.split("\n") if text is not None else []
        at = i if i is not None else float("-inf")
        gone = {p for p, x in enumerate(lines) if x in first and (first[x] != (at, p) or any(first[b] < first[x] for b in links[x]))}
        kept = None if text is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out.append((str(i), kept, len(lines), len(gone), sum(len(links[x]) for x in lines if x in links)))
    return sorted(out, key=str)


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_equals_brute_force(spark, distance):
    rnd = random.Random(9)
    pool = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(3, 30))) for _ in range(40)]
    pool += [changed(rnd, rnd.choice(pool), rnd.randint(0, 3)) for _ in range(120)]
    rows = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for k in range(60)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, pool[0]), (None, "null id " + pool[1]), (204, "long " * 3000)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, n_lines string, place int").repartition(3)
    got = dedup_lines(docs, distance, 5).collect()
    assert sorted(((str(r.doc_id), r.kept_text, r.n_lines, r.n_removed, r.n_links) for r in got), key=str) == brute(rows, distance, 5)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a line that repeats\nx"), (1, "a line that repeats\nx"), (2, "a line that repeats")], "doc_id long, text string")
    got = sorted((r.doc_id, r.kept_text) for r in dedup_lines(docs, 1, 5).collect())
    assert got == [(1, "a line that repeats\nx"), (1, "a line that repeats\nx"), (2, "")]
    assert dedup_lines(docs.limit(0), 1, 5).collect() == []
    with pytest.raises(ValueError, match="longer than the distance"):
        dedup_lines(docs, 3, 3)


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a line that repeats")], "doc_id long, text string")
    plan = dedup_lines(docs, 1, 5)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_equals_brute_force_with_hot_segments(spark, monkeypatch):
    """Nearly every segment counts as hot, and lines meet by their parts."""
    from adit.llm import lines

    rnd = random.Random(12)
    for hot in (0, 1, 3):
        monkeypatch.setattr(lines, "HOT", hot)
        pool = ["tmpl " + "".join(rnd.choice("01é") for _ in range(rnd.randint(1, 5))) + rnd.choice([" end", " ends", ""]) for _ in range(120)]
        rows = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for k in range(40)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = sorted(((str(r.doc_id), r.kept_text, r.n_lines, r.n_removed, r.n_links) for r in dedup_lines(docs, 1, 6).collect()), key=str)
        assert got == brute(rows, 1, 6)


def test_templated_lines_meet_few_others(spark, monkeypatch):
    """Numbered lines of one template: pairs grow with the true links, not with the square."""
    from adit.llm import lines

    seen, wrote = {}, lines.materialize
    monkeypatch.setattr(lines, "materialize", lambda df, name: seen.setdefault(name, wrote(df, name)))
    numbers = spark.range(20_000).select((F.col("id") % 200).alias("doc_id"), F.format_string("Copyright notice, page number %05d of all", "id").alias("line"))
    docs = numbers.groupBy("doc_id").agg(F.array_join(F.collect_list("line"), "\n").alias("text"))
    total = dedup_lines(docs, 1, 20).agg(F.sum("n_links"), F.sum("n_lines")).first()
    assert tuple(total) == (20_000 * 37, 20_000)  # the first digit may be the other of two, the rest one of nine others
    assert seen["line-pairs"].count() == 20_000 * 37 // 2


def test_extra_columns_with_any_name(spark):
    names = ["doc", "print", "gone", "h", "g", "line", "place", "first", "links", "times", "row", "lines", "__lines", "__doc"]
    rows = [(k, "one line that is long enough\nand another of its kind " + str(k % 2), *range(len(names))) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    plain = {r.doc_id: r.kept_text for r in dedup_lines(docs.select("doc_id", "text"), 1, 20).collect()}
    got = dedup_lines(docs, 1, 20).collect()
    assert {r.doc_id: r.kept_text for r in got} == plain and all([r[n] for n in names] == list(range(len(names))) for r in got)
