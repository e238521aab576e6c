"""Conversation structure repair: the cheapest edits that give every conversation a legal order of turns.

Repair is a lightest-derivation problem over a weighted hypergraph. An item (i, q) says that i rows are consumed and the
roles written so far leave the grammar `(s?(ua)+)?` in state q; its weight is (cost, audit). A deduction takes such an item and
what the next row, or the next piece of rows, offers from state q, and adds costs and audit letters. Every deduction is
superior (its weight is never below the item's it starts from), so Knuth's agenda settles each item when it is popped first and
may stop at the goal.

Pieces of a conversation are items too: (p, q) with the lightest edits that lead from p to q. A piece never ends with an
insertion, so no audit of a piece is a proper beginning of another one and audits of joined pieces compare piece by piece.
That makes repair associative: a conversation of any length is solved in pieces of bounded length that are merged in a tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from adit.session import materialize

#: Fixed values of the contract: grammar states (0 start, 1 after s, 2 after u, 3 after a), the role an edit writes, costs.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WRITES = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
ACCEPTS = (0, 3)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"

#: Rows of one piece, pieces merged at once, and what a task keeps of one conversation before it hands it to the pieces.
PIECE, FAN = 512, 32
KEEP_ROWS, KEEP_BYTES = 4096, 8 << 20

SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
PIECE_COLUMNS = (
    "part int, slot long, entries array<struct<p int, q int, cost long, audit string>>, blank long, duplicate long, truncated long, illegal long, "
    "head string, tail string, low long, high long, turns long"
)


def agenda(first, empty, deductions: Callable) -> Iterator[tuple]:
    """Knuth's algorithm: items with their lightest weights, in the order in which they are settled.

    Starts from `first` with cost 0 and the audit `empty`; `deductions(item, weight)` gives (consequence, weight) pairs, and
    weights grow along every deduction.
    """
    settled, waiting = set(), [((0, empty), first)]
    while waiting:
        weight, item = heappop(waiting)
        if item in settled:
            continue
        settled.add(item)
        yield item, weight
        for head, heavier in deductions(item, weight):
            if head not in settled:
                heappush(waiting, (heavier, head))


def row_edits(marks: str, closed: bool) -> Callable:
    """Deductions over rows. A mark is x (must go) or the role's initial s, u, a or o for others, upper case where truncated."""

    def deductions(item, weight):
        i, q = item
        cost, audit = weight
        role, written = WRITES[q]
        if i < len(marks):
            mark = marks[i]
            yield (i + 1, q), (cost + DELETE, audit + "D")
            if mark != "x":
                more = TRUNCATED if mark.isupper() else 0
                kept = STEP.get((q, mark.lower()))
                if kept is not None:
                    yield (i + 1, kept), (cost + more, audit + "K")
                yield (i + 1, written), (cost + REROLE + more, audit + "R")
            yield (i, written), (cost + INSERT, audit + "I")
        elif not closed:
            yield (i, written), (cost + INSERT, audit + "I")

    return deductions


def solve_rows(marks: str) -> tuple[int, str]:
    for (i, q), (cost, audit) in agenda((0, 0), "", row_edits(marks, False)):
        if i == len(marks) and q in ACCEPTS:
            return cost, audit


@lru_cache(4096)
def piece_table(marks: str) -> tuple:
    """(p, q, cost, audit) of the lightest edits of these rows between any two states."""
    return tuple(
        (p, q, cost, audit) for p in WRITES for (i, q), (cost, audit) in agenda((0, p), "", row_edits(marks, True)) if i == len(marks)
    )


def ranked(table) -> tuple[dict[int, list[tuple[int, int, int]]], list[str]]:
    """A piece's entries by state p as (q, cost, rank of the audit among the piece's audits), and these audits in order."""
    order = {audit: k for k, audit in enumerate(sorted({audit for *_, audit in table}))}
    out: dict[int, list] = {}
    for p, q, cost, audit in table:
        out.setdefault(p, []).append((q, cost, order[audit]))
    return out, sorted(order)


def piece_deductions(pieces: list[dict], closed: bool) -> Callable:
    """Deductions over whole pieces: a prefix item and a piece's (p, q) item give the longer prefix. Audits are ranks here."""

    def deductions(item, weight):
        k, q = item
        cost, ranks = weight
        if k < len(pieces):
            for to, more, rank in pieces[k].get(q, ()):
                yield (k + 1, to), (cost + more, (*ranks, rank))
        elif not closed:
            yield (k, WRITES[q][1]), (cost + INSERT, (*ranks, -1))

    return deductions


def spell(ranks: tuple, audits: list[list[str]]) -> str:
    return "".join(audits[k][r] for k, r in enumerate(ranks[: len(audits)])) + "I" * (len(ranks) - len(audits))


def merge_tables(tables: list) -> list[tuple]:
    """The table of pieces that follow each other."""
    pieces, audits = zip(*map(ranked, tables))
    return [
        (p, q, cost, spell(ranks, audits)) for p in WRITES for (k, q), (cost, ranks) in agenda((0, p), (), piece_deductions(pieces, True)) if k == len(pieces)
    ]


def solve_tables(tables: list) -> tuple[int, str]:
    """The goal over all pieces of a conversation, from the start state."""
    pieces, audits = zip(*map(ranked, tables))
    for (k, q), (cost, ranks) in agenda((0, 0), (), piece_deductions(pieces, False)):
        if k == len(pieces) and q in ACCEPTS:
            return cost, spell(ranks, audits)


@lru_cache(1 << 14)
def solve_short(marks: str) -> tuple[int, str]:
    return solve_rows(marks)


def solve(marks: str) -> tuple[int, str]:
    """(cost, audit) of the lightest repair."""
    if len(marks) <= PIECE:
        return solve_short(marks) if len(marks) <= 64 else solve_rows(marks)
    return solve_tables([piece_table(marks[i : i + PIECE]) for i in range(0, len(marks), PIECE)])


class Writer:
    """Applies audit letters to rows in their order, and hashes what comes out."""

    def __init__(self, audit: str, keep: bool):
        self.audit, self.at, self.state, self.place = audit, 0, 0, 0
        self.digest, self.rows = hashlib.sha256(), [] if keep else None

    def put(self, edit: str, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        if self.rows is not None:
            self.rows.append((self.place, edit, role, text))
        self.place += 1

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = WRITES[self.state]
            self.put("insert", role, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEP[self.state, role[:1]]
            self.put("keep", role, text)
        elif edit == "R":
            role, self.state = WRITES[self.state]
            self.put("rerole", role, text)

    def taken(self) -> list:
        rows, self.rows = self.rows or [], [] if self.rows is not None else None
        return rows


def mark_of(role: str, code: str, duplicate: bool) -> str:
    if code == "b" or duplicate:
        return "x"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if code == "t" else initial


def repaired_here(rows: list[tuple], keep: bool) -> tuple[dict, list]:
    """A conversation that is whole and short: rows of (turn, role, text, code)."""
    seen, marks, blank, duplicate, truncated, illegal, last = set(), [], 0, 0, 0, 0, None
    for turn, role, text, code in rows:
        again = code != "b" and (role, text) in seen
        seen.add((role, text))
        blank += code == "b"
        duplicate += again
        truncated += code == "t" and not again
        illegal += last is not None and last + role[:1] not in LEGAL
        last = role[:1]
        marks.append(mark_of(role, code, again))
    cost, audit = solve("".join(marks))
    writer = Writer(audit, keep)
    for _, role, text, _ in rows:
        writer.row(role, text)
    writer.inserts()
    turns = {turn for turn, *_ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    found = dict(gaps=gaps, blank=blank, duplicate=duplicate, truncated=truncated, illegal=illegal, cost=cost, audit=audit)
    return {**found, "repaired_sha256": writer.digest.hexdigest()}, writer.taken()


def first_pass(schema: pa.Schema, keep: bool) -> Callable:
    """Sorted rows to finished conversations, and to rows of those that are long or that a task sees only a part of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        size, run_id, rows, kept, edge, index = 0, None, None, 0, True, 0

        def hand_over(rows):
            out.extend({"conv_id": c, "part": part, "idx": i, "turn": t, "role": r, "text": x, "code": k} for c, t, r, x, k, i in rows)

        def close(at_end: bool):
            nonlocal rows, kept, edge
            if rows is None:
                return
            if edge or at_end:
                hand_over(rows)
            else:
                summary, written = repaired_here([(t, r, x, k) for _, t, r, x, k, _ in rows if k != "x"], keep)
                if keep:
                    out.extend({"conv_id": run_id, "place": p, "edit": e, "role": r, "text": x} for p, e, r, x in written)
                else:
                    out.append({"conv_id": run_id, **summary})
            rows, kept, edge = None, 0, False

        for batch in batches:
            for c, t, r, x, k in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "code"))):
                if rows is None or c != run_id:
                    close(False)
                    run_id, rows = c, []
                rows.append((c, t, r, x, k, index))
                index += 1
                kept += len(x) + len(r)
                if len(rows) >= KEEP_ROWS or kept >= KEEP_BYTES:  # too long for here: this run goes on as an edge
                    hand_over(rows)
                    rows, kept, edge = [], 0, True
                size += len(x) + 64
                if size >= 4 << 20 and out:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
                    size = 0
        close(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def spark_schema(conv: StructField, rest: str) -> StructType:
    return StructType([StructField("conv_id", conv.dataType), *StructType.fromDDL(rest).fields])


def pieces_of(schema: pa.Schema) -> Callable:
    """Rows of one slot (part, idx // PIECE), in order, to a piece for each conversation among them."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("idx", "conv_id", "turn", "role", "code", "again"))), key=lambda r: r[0])
        part, out, k = table.column("part")[0].as_py(), [], 0
        while k < len(rows):
            first, conv, marks, turns = k, rows[k][1], [], []
            counts, head, tail = dict(blank=0, duplicate=0, truncated=0, illegal=0), None, None
            while k < len(rows) and rows[k][1] == conv:
                _, _, turn, role, code, again = rows[k]
                k += 1
                if code == "x":
                    continue
                counts["blank"] += code == "b"
                counts["duplicate"] += again
                counts["truncated"] += code == "t" and not again
                counts["illegal"] += tail is not None and tail + role[:1] not in LEGAL
                tail = role[:1]
                head = tail if head is None else head
                marks.append(mark_of(role, code, again))
                if turn is not None:
                    turns.append(turn)
            entries = [dict(p=p, q=q, cost=c, audit=a) for p, q, c, a in piece_table("".join(marks))]
            out.append(
                dict(conv_id=conv, part=part, slot=rows[first][0] // PIECE, entries=entries, **counts, head=head, tail=tail, turns=len(set(turns)), low=min(turns, default=None), high=max(turns, default=None))
            )
        return pa.Table.from_pylist(out, schema)

    return run


def joined(pieces: list[dict]) -> dict:
    """Everything but the entries of pieces that follow each other, in order."""
    out = dict(pieces[0])
    for piece in pieces[1:]:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            out[c] += piece[c]
        if piece["head"] is not None:
            out["illegal"] += out["tail"] is not None and out["tail"] + piece["head"] not in LEGAL
            out["head"] = piece["head"] if out["head"] is None else out["head"]
            out["tail"] = piece["tail"]
        if piece["low"] is not None:
            out["turns"] += piece["turns"] - (out["high"] == piece["low"])
            out["low"] = piece["low"] if out["low"] is None else out["low"]
            out["high"] = piece["high"]
    return out


def table_of(piece: dict) -> list[tuple]:
    return [(e["p"], e["q"], e["cost"], e["audit"]) for e in piece["entries"]]


def merged(schema: pa.Schema, key: str) -> Callable:
    """Up to FAN neighbouring pieces of one conversation to one."""

    def run(table: pa.Table) -> pa.Table:
        pieces = sorted(table.select(schema.names).to_pylist(), key=lambda r: (r["part"], r["slot"]))
        out = joined(pieces)
        if len(pieces) > 1:
            out["entries"] = [dict(p=p, q=q, cost=c, audit=a) for p, q, c, a in merge_tables([table_of(x) for x in pieces])]
        out[key] = pieces[0][key] // FAN
        return pa.Table.from_pylist([out], schema)

    return run


def finished(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for piece in batch.to_pylist():
                cost, audit = solve_tables([table_of(piece)])
                gaps = piece["high"] - piece["low"] + 1 - piece["turns"] if piece["low"] is not None else 0
                out.append({**{c: piece.get(c) for c in ("conv_id", *COUNTS)}, "gaps": gaps, "cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def second_pass(schema: pa.Schema, keep: bool) -> Callable:
    """A summary row, then its conversation's rows in order: hashed as they stream by, nothing kept but the audit."""
    summary = [n for n in ("conv_id", *COUNTS, "cost", "audit")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, writer, out = None, None, []

        def close():
            if writer is None:
                return
            writer.inserts()
            take()
            if not keep:
                out.append({**now, "repaired_sha256": writer.digest.hexdigest()})

        def take():
            out.extend({"conv_id": now["conv_id"], "place": p, "edit": e, "role": r, "text": x} for p, e, r, x in writer.taken())

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] < 0:
                    close()
                    now = {c: row[c] for c in summary}
                    writer = Writer(row["audit"], keep)
                elif row["code"] != "x":
                    writer.row(row["role"], row["text"])
            if writer is not None:
                take()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def levels(found: DataFrame, schema: pa.Schema) -> DataFrame:
    """One piece for each conversation: neighbours are merged within a part first, then over parts, FAN at a time."""
    struct = found.schema
    for key in ("slot", "part"):
        top = found.agg(F.max(key)).first()[0] or 0
        while top > 0:
            others = ["conv_id", "part"] if key == "slot" else ["conv_id"]
            found = found.withColumn("near", F.floor(F.col(key) / FAN)).groupBy(*others, "near").applyInArrow(merged(schema, key), struct)
            found = materialize(found, "pieces")
            top //= FAN
        if key == "slot":
            found = found.withColumn("slot", F.lit(0).cast("long"))
    return found


def plan(rows: DataFrame, present, keep: bool) -> DataFrame:
    """Both outputs: summaries, or with `keep` the repaired rows."""
    conv = rows.schema["conv_id"]
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), F.when(present, text).otherwise("").alias("text"), present.alias("present"))
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    code = F.when(~F.col("present"), "x").when(last == "", "b").when(last.isin(".", "!", "?"), "o").otherwise("t")
    coded = plain.select("conv_id", "turn", "role", "text", code.alias("code"), F.substring("text", 1, 64).alias("near"), F.xxhash64("text").alias("print"), F.monotonically_increasing_id().alias("nth"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "near", "print", "nth"]
    ordered = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "code")

    flat = spark_schema(conv, f"{SUMMARY}, place long, edit string, part int, idx long, turn long, role string, text string, code string")
    passed = materialize(ordered.mapInArrow(first_pass(to_arrow_schema(flat), keep), flat), "turns")

    rest = passed.where("part IS NOT NULL").select("conv_id", "part", "idx", "turn", "role", "text", "code")
    identity = F.md5(F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), F.lit("\n"), F.length("role").cast("string"), F.lit(":"), "role", "text"))
    light = rest.select("conv_id", "part", "idx", "turn", "role", "code", F.when(F.col("code").isin("o", "t"), identity).alias("same"))
    here = F.struct("part", "idx")
    firsts = light.where("same IS NOT NULL").groupBy("same").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first")
    known = light.join(firsts, "same", "left").withColumn("again", F.coalesce(here != F.col("first"), F.lit(False)))
    pieces = spark_schema(conv, PIECE_COLUMNS)
    piece_schema = to_arrow_schema(pieces)
    cut = known.withColumn("slot", F.floor(F.col("idx") / PIECE)).groupBy("part", "slot").applyInArrow(pieces_of(piece_schema), pieces)
    whole = levels(materialize(cut, "pieces"), piece_schema)
    summary = spark_schema(conv, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    solved = whole.mapInArrow(finished(to_arrow_schema(summary)), summary)

    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in summary.fields[1:]]
    heads = solved.select("*", F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("idx"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("code"))
    tails = rest.select("conv_id", *nothing, "part", "idx", "role", "text", "code")
    streamed = heads.unionByName(tails).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "idx")
    out = spark_schema(conv, "place long, edit string, role string, text string" if keep else SUMMARY)
    long_ones = streamed.mapInArrow(second_pass(to_arrow_schema(out), keep), out)
    return passed.where("part IS NULL").select(*out.names).unionByName(long_ones)


def repair(rows: DataFrame, present=None) -> DataFrame:
    """A row for each conversation of `rows` (conv_id, turn, role, text): faults, and the cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Nulls in role and text count as one
    space, a null conv_id is a conversation of its own, rows without a turn come first. Rows of one turn are ordered by role,
    the text's first 64 characters and a hash of the text; equal rows are interchangeable. A role of no letters can't be
    kept. `present` (a Boolean column) may mark rows that are gone but whose conversation is still to be
    reported; one without any row left has zeros, an empty audit and the hash of nothing. An empty table gives an empty
    table; extra columns are ignored.

    Rows are dealt by ranges of conversation and turn. A conversation that lies whole in one task and is short is solved there;
    those at a task's edges, and long ones, are solved in pieces of PIECE rows that are merged FAN at a time, with their
    duplicates found by a grouped hash of 128 bits. No task holds a long conversation, except for its audit, which is one cell of
    the result: an inner merge holds about 20 bytes a row below it. One SHA-256 over a conversation's text can only be
    formed in order, so a single task reads a long conversation's rows for that, one Arrow batch at a time.
    """
    return plan(rows, F.lit(True) if present is None else F.coalesce(present, F.lit(False)), False)


def repaired_rows(rows: DataFrame, present=None) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), edit (keep, rerole or insert), role and text."""
    return plan(rows, F.lit(True) if present is None else F.coalesce(present, F.lit(False)), True)


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of `conv_id:turn` modulo 20. Nulls become one space; dropped rows stay with `present` false."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.pmod(F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", spaced[2].alias("role"), spaced[3].alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"), copies.alias("copy")).drop("copy")
