import math
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from adit.llm import personal as p

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(p.KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" and len(m[0]) < 4000 else False, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}
            if ok[kind]:
                out.append((k, m.start(), m.end()))
    return out


def sign(c):
    return 0 if c == "" else p.SIGNS.find(c) + 2 if c in p.SIGNS else 1


def neighbour(c):
    return 0 if c == "" else 1 if c in "\n\r" else 2 if c in " \t\x0b\x0c" else 3 if regex.match(r"\p{L}", c) else 4 if c in "0123456789" else 5


def proposals(text):
    """(kind, start, end, generator, features) in plain Python."""
    out = []
    for g, (kind, pattern) in enumerate(p.WIDE):
        found = list(regex.finditer(pattern, text))
        for k, m in enumerate(found):
            left = text[found[k - 1].end() if k else 0 : m.start()][-24:]
            after = text[m.end() : found[k + 1].start() if k + 1 < len(found) else None][:1]
            t, before = m[0], re.sub(r"\+?[0-9]{0,3} ?\Z", "", left, count=1)
            signs = re.sub("[0-9A-Za-z]", "", t)
            context = next((i + 1 for i, words in enumerate(p.CONTEXT) if re.search(words, left.lower())), 0)
            x = [p.KINDS.index(kind), min(24, sum(c.isdigit() for c in t)), min(48, len(t)), min(12, len(signs)), sign(signs[:1]), sign(signs[-1:]), neighbour(before[-1:]), neighbour(after), context]
            x += [len(re.match("[^0-9]*([0-9]*)", t[:40])[1]), len(re.search("([0-9]*)[^0-9]*$", t[-40:])[1]), min(30, sum(c.isascii() and c.isalpha() for c in t))]
            out.append((x[0], m.start(), m.end(), g, x))
    return out


def value(tree, x):
    feature, limit, *sides = tree
    f, at, left, right = sides[x[feature] > limit]
    return right if x[f] > at else left


def every(text, model):
    """Base spans, and the added ones by the model."""
    known, enough = base(text), []
    for kind, a, b, g, x in proposals(text):
        s = round(1 / (1 + math.exp(-(model.start + sum(value(t, x) for t in model.trees)))), 3)
        if model.thresholds[kind] is not None and s >= model.thresholds[kind] and not any(c < b and d > a for _, c, d in known):
            enough.append((kind, a, b, (-s, g)))
    return sorted(known + [(k, a, b) for k, a, b, r in enough if not any(c < b and d > a and q < r for _, c, d, q in enough)])


def texts(seed=5, n=400):
    rnd = random.Random(seed)
    pool = [
        lambda: f"ann.{rnd.randint(1, 99)}@mail{rnd.randint(1, 9)}.example.com",
        lambda: ".".join(str(rnd.choice([0, 7, 31, 255, 256, 1000, 13])) for _ in range(rnd.choice([3, 4, 4, 4, 5, 8]))),
        lambda: "".join(str(rnd.randint(0, 9)) for _ in range(rnd.choice([15, 16, 16, 19, 20]))),
        lambda: "4539 1488 0343 6467",
        lambda: "4539-1488-0343-6467.",
        lambda: f"+{rnd.randint(1, 99)} ({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)}",
        lambda: f"+1 ({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)}",
        lambda: f"+{rnd.randint(1, 99)} ({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)} so" if rnd.random() < 0.8 else f"({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)}",
        lambda: f"+1 (826) 555-{rnd.randint(1000, 9999)} so" if rnd.random() < 0.8 else f"+1 (826) 555-4081 {rnd.randint(1, 255)}.137.223.204",
        lambda: "a@b.c_d@e.f@g.h", lambda: "x@y", lambda: "bob [at] host (dot) org", lambda: "look at this.thing", lambda: "𝔸über, 12", lambda: "1 2 3-4", lambda: "order 12/34/5678", lambda: "\n", lambda: "007.08.9.010",
    ]
    words = ["the", "phone", "mail:", "Card", "and", "ä", "x!", "Server", "—"]
    return ["", None, " ", *(" ".join(rnd.choice(words) if rnd.random() < 0.5 else rnd.choice(pool)() for _ in range(rnd.choice([1, 4, 12, 40]))) for _ in range(n))]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts())] + [(None, "id@less.one", "x", "y", 1), (5, "again@five.net", "x", "y", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, base_spans string, kind int").repartition(4)


@pytest.fixture(scope="module")
def model(documents):
    return p.train(documents, precision=0.7, support=10)


def test_base_and_added_spans_against_plain_python(documents, model):
    assert model.trees and any(t is not None for t in model.thresholds)
    rows = p.find_personal(documents, model).collect()
    assert len(rows) == documents.count() and rows[0].kind == 1
    more = 0
    for r in rows:
        text = r.text or ""
        assert [tuple(s) for s in r.base_spans] == base(text), text
        assert [tuple(s) for s in r.spans] == every(text, model), text
        more += len(r.spans) - len(r.base_spans)
    assert more > 20


def test_numbers_that_a_neighbour_hid_are_added(documents, model):
    hidden = [(r.text, r.spans) for r in p.find_personal(documents, model).collect() if r.text and "+1 (826) 555-4081 " in r.text]
    missed = sum(not any(s.start <= m.start() and s.finish >= m.end() for s in spans) for text, spans in hidden for m in re.finditer(r"\(826\) 555-4081", text))
    assert hidden and missed == 0


def test_long_texts(spark, model):
    many = " ".join(f"+1 (300) 555-{i:04d} u{i}@x.org" for i in range(3000))
    runs = ["7" * 9_000, "a" * 9_000, "1 " * 30_000, "1." * 30_000, "a@" * 30_000, "+1" * 30_000, "a.b@c" * 9_000, "12 at 3" * 9_000, many]
    plain = ["7" * 1_000_000, "a" * 1_000_000, "a@" * 500_000, "+1" * 500_000]  # nothing in them; plain Python would need their square
    frame = spark.createDataFrame(list(enumerate(runs + plain)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.base_spans] for r in p.find_personal(frame, model).collect()}
    assert got == {**{i: base(t) for i, t in enumerate(runs)}, 9: [], 10: [], 11: [], 12: []} and len(got[8]) == 6000


def test_redaction(documents, model):
    for r in p.find_personal(documents, model).select("*", p.redacted(F.coalesce("text", F.lit("")), F.col("spans")).alias("clean")).collect():
        out, at = "", 0
        for kind, a, b in sorted(map(tuple, r.spans), key=lambda s: (s[1], s[2], s[0])):
            if a >= at:
                out, at = out + (r.text or "")[at:a] + f"[{p.KINDS[kind]}]", b
            else:
                at = max(at, b)
        assert r.clean == out + (r.text or "")[at:]


def test_best_split_against_all_splits():
    rnd = random.Random(1)
    rows = [([rnd.randint(0, 4), rnd.randint(0, 3)], rnd.uniform(-1, 1), rnd.uniform(0.1, 1)) for _ in range(60)]
    counted = {}
    for x, g, h in rows:
        for f, v in enumerate(x):
            a, b = counted.get((f, v), (0, 0))
            counted[f, v] = (a + g, b + h)

    def leaf(part):
        return sum(g for _, g, _ in part), sum(h for _, _, h in part) + p.PRIOR

    def gain(f, v):
        sides = [leaf([r for r in rows if (r[0][f] > v) == side]) for side in (False, True)]
        return sum(g * g / h for g, h in sides) - leaf(rows)[0] ** 2 / leaf(rows)[1], f, v, *(p.RATE * g / h for g, h in sides)

    want = max((gain(f, v) for f in (0, 1) for v in range(5)), key=lambda s: round(s[0], 9))
    assert p.best_split(counted) == pytest.approx(want)


def test_calibration_pools_to_rising_rates():
    assert p.calibrated([(0.1, 100, 5), (0.5, 10, 9), (0.6, 10, 9), (0.9, 50, 50)], 0.9, 20) == 0.5
    assert p.calibrated([(0.1, 100, 5), (0.5, 10, 10), (0.9, 50, 40)], 0.9, 20) is None
    assert p.calibrated([(0.9, 10, 10)], 0.9, 20) is None and p.calibrated([], 0.9, 20) is None


def test_empty_table_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    nothing = spark.createDataFrame([(1, "no data"), (2, None), (3, "")], "doc_id long, text string")
    assert p.find_personal(empty, p.train(empty)).count() == 0
    assert all(r.spans == [] for r in p.find_personal(nothing, p.train(nothing)).collect())


def test_no_python_in_the_plan(documents, model):
    plan = p.find_personal(documents, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
