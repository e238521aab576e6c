import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from adit.llm import conversations as c

GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(marks):
    """Independent of the agenda: the best (cost, audit) for every state, row by row, with all runs of up to two insertions."""
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(2):
            for q, (cost, audit) in list(best.items()):
                to, new = c.WRITES[q][1], (cost + 3, audit + "I")
                if to not in best or new < best[to]:
                    best[to] = new
        return best

    for mark in marks:
        new = {}
        for q, (cost, audit) in inserted(dict(best)).items():
            more = 3 if mark.isupper() else 0
            ways = [(q, 4, "D")]
            if mark != "x":
                ways.append((c.WRITES[q][1], 3 + more, "R"))
                if (q, mark.lower()) in c.STEP:
                    ways.append((c.STEP[q, mark.lower()], more, "K"))
            for to, price, letter in ways:
                way = (cost + price, audit + letter)
                if to not in new or way < new[to]:
                    new[to] = way
        best = new
    ends = inserted(dict(best))
    return min(ends[q] for q in (0, 3) if q in ends)


def from_all_edits(marks):
    """Every sequence of edits with up to two insertions at any place."""
    found = []
    for letters in itertools.product(*["D" if m == "x" else "DKR" for m in marks]):
        for gaps in itertools.product(range(3), repeat=len(marks) + 1):
            audit = "I" * gaps[0] + "".join(letter + "I" * g for letter, g in zip(letters, gaps[1:]))
            for fill in itertools.product("ua", repeat=sum(x in "IR" for x in audit)):
                fill, rows, roles, cost = iter(fill), iter(marks), "", 0
                for x in audit:
                    mark = None if x == "I" else next(rows)
                    roles += next(fill) if x in "IR" else "" if x == "D" else mark.lower()
                    cost += {"I": 3, "R": 3, "D": 4, "K": 0}[x] + (3 if x in "KR" and mark.isupper() else 0)
                if GRAMMAR.fullmatch(roles):
                    found.append((cost, audit))
    return min(found)


def test_lightest_repair_against_all_edits():
    rnd = random.Random(3)
    cases = ["".join(p) for n in range(3) for p in itertools.product("suaoxSUAO", repeat=n)] + ["".join(rnd.choices("suaoxSUAO", k=3)) for _ in range(12)]
    for marks in cases:
        assert c.solve_rows(marks) == from_all_edits(marks) == cheapest(marks), marks


def test_pieces_merge_to_the_same_repair(monkeypatch):
    rnd = random.Random(4)
    monkeypatch.setattr(c, "PIECE", 7)
    for n in (0, 1, 6, 7, 8, 40, 200):
        for _ in range(15):
            marks = "".join(rnd.choices("suaoxSUAO", weights=[2, 8, 8, 1, 3, 1, 2, 2, 1], k=n))
            assert c.solve(marks) == cheapest(marks), marks
            pieces = [c.piece_table(marks[i : i + 7]) for i in range(0, n, 7)] or [c.piece_table("")]
            halves = [c.merge_tables(pieces[:3]), c.merge_tables(pieces[3:])] if len(pieces) > 3 else [c.merge_tables(pieces)]
            assert c.solve_tables(halves) == cheapest(marks), marks


def brute(rows):
    """The contract, row by row, for (conv_id, turn, role, text) rows."""
    damaged, out = {}, {}
    for conv, turn, role, text in rows:
        spaced = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        fault = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = spaced[2], spaced[3]
        text = "" if fault == 1 else re.sub(r"[.!?]", "", text) if fault == 2 else text
        damaged.setdefault(conv, []).extend([(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    for conv, kept in damaged.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marks, counts = set(), "", [0, 0, 0]
        for _, role, text in kept:
            ends = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not ends else 1 if (role, text) in seen else 2 if ends[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            initial = role[0] if role and role[0] in "sua" else "o"
            marks += "x" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = cheapest(marks)
        repaired, rest = [], iter(kept)
        for x in audit:
            _, role, text = (None, None, "") if x == "I" else next(rest)
            if x != "D":
                repaired.append([role if x == "K" else None, text])
        start = bool(repaired) and (repaired[0][0] or "u")[0] == "s"
        for k, pair in enumerate(repaired):
            pair[0] = pair[0] or ("user" if (k - start) % 2 == 0 else "assistant")
        assert GRAMMAR.fullmatch("".join(r[0] for r, _ in repaired))
        turns = {t for t, *_ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), text)
    return out


def made(seed, convs=120, long=()):
    rnd, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        n = dict(long).get(conv, rnd.choice([0, 1, 2, 5, 9]))
        for turn in range(n):
            role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.2 else ("user", "assistant")[turn % 2]
            role = rnd.choice([role] * 12 + ["system", "tool", "", None, "User"])
            text = rnd.choice(["Yes.", "No?", "why\n", "", None, " \t", "x" * 40 + ". " + str(rnd.random()), "über!\x0b", "ends. Not", "a:b\nc."])
            rows.append((conv, None if rnd.random() < 0.03 else turn if rnd.random() < 0.95 else turn + 3, role, text))
    rnd.shuffle(rows)
    return rows


COLUMNS = "conv_id long, turn long, role string, text string, part int, idx int, again string, audit string"


def frame(spark, rows, parts):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], COLUMNS).repartition(parts)


def compare(spark, rows, parts=3):
    got = {r["conv_id"]: tuple(r)[1:] for r in c.repair(c.damage(frame(spark, rows, parts)), F.col("present")).collect()}
    want = {k: v[:-1] for k, v in brute(rows).items()}
    assert got == want
    return got


def test_repair_against_the_contract(spark):
    got = compare(spark, made(1))
    assert sum(v[1] for v in got.values()) and sum(v[2] for v in got.values()) and sum(v[0] for v in got.values())


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(c, "KEEP_ROWS", 6)
    compare(spark, made(2, 40, {3: 3000, 5: 700, None: 600}.items()))


def test_one_conversation_and_repeated_rows(spark):
    compare(spark, [(7, 1, "user", "Same.")] * 500 + [(7, 2, "assistant", "Same.")] * 300)


def test_repaired_rows_are_what_was_hashed(spark):
    rows = made(5, 30, {4: 900}.items())
    lines = {}
    for r in sorted(c.repaired_rows(c.damage(frame(spark, rows, 2)), F.col("present")).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {k: "\n".join(v) for k, v in lines.items()} == {k: v[-1] for k, v in brute(rows).items() if v[-1]}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(None, None, "", "")]])
def test_empty_and_null(spark, rows):
    got = compare(spark, rows, 1)
    assert len(got) == len(rows)


def test_a_conversation_of_which_nothing_is_left(spark):
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert compare(spark, [(dropped, 0, "user", "Gone.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
