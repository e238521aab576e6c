"""Personal data: e-mail addresses, network addresses, card and phone numbers. DataFrame functions only.

Fixed patterns with their checks give the base spans. Beside them, wider generators propose spans that may overlap: other
separators, bracketed or spelt signs, numbers without a country code. A gradient-boosted ensemble of small trees scores them by
their format and context. It learns from the table itself: a proposal that meets a base span of its kind is an example, every other one
counts as none, and neither the sign that makes a base span nor its check is a feature. Proposals are counted by their
features first, so boosting works on a table of distinct feature rows, whatever the corpus; trees are CASE expressions. Scores are
calibrated on proposals that were held out (by a hash of the proposal, so copies stay together), made monotone, and a
kind's threshold is the least score that is right often enough. What lies above it and meets no base span is added.

Everything about a document happens inside its row: nothing is shuffled but the counts of feature rows. Null and empty
texts have no spans; every row is returned, so ids may repeat or be null; extra columns are kept by `find_personal`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adit.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the contract. Runs are taken whole and begun only at their start, so that a long run costs its length once and no
#: group is repeated on the stack: (?<!...) with \G, the end of the last match, is where an attempt can succeed at all.
NAME = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{NAME})|\G){NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider generators: (kind, pattern).
WIDE = (
    ("email", rf"(?:(?<!{NAME})|\G){NAME}++(?: ?(?:\[at\]|\(at\)|@) ?| at )[A-Za-z0-9-]++(?:(?: ?(?:\[dot\]|\(dot\)) ?| dot |\.)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]{1,3}+(?:(?:\[?\.\]?|\[dot\]|\(dot\))[0-9]{1,3}+){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9](?:[ ./-]?+[0-9]){12,18}+(?![0-9])"),
    ("phone", r"\([0-9]{2,4}+\) ?[0-9]{2,4}+[ .-]?[0-9]{3,4}+(?![0-9])"),
    ("phone", r"(?<![0-9])[0-9]{2,4}+(?:[ ./-][0-9]{2,4}+){2,4}(?![0-9])"),
)
#: A text without any of these holds no proposal of the kind.
NEEDS = {"email": r"@|[\[(]at[\])]| at ", "ip": "[0-9]", "card": "[0-9]{2}", "phone": "[0-9]{2}"}
#: Words before a proposal that say what it is.
CONTEXT = ("mail|contact|write", "tel|phone|call|fax|mobile", "card|visa|pay|account", "host|server|addr|client", "order|invoice|version|serial|ref")
SIGNS = " .-()[]/@"
SPAN = "start long, finish long, kind int, text string, left string, after string"
BLOCK = 64

#: Boosting: rounds of trees with four leaves, step, and weight of a leaf's prior.
ROUNDS, RATE, PRIOR = 10, 0.4, 4.0
#: How often a proposal at the threshold must be right, and the held-out examples that a kind needs to be judged.
PRECISION, SUPPORT = 0.9, 20
FEATURES = ("kind", "digits", "length", "signs", "first_sign", "last_sign", "before", "behind", "context", "first_group", "last_group", "letters")


def bind(value: Column, use) -> Column:
    """`use(value)`, with the value computed once a row however often it is used, inside lambdas too."""
    return F.transform(F.array(value), use)[0]


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda t, x: t + x)


def in_blocks(items: Column) -> Column:
    """A non-empty array in slices of BLOCK."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))


def sums_before(numbers: Column) -> Column:
    """For each number of a non-empty array, the sum of those before it: inside blocks, then over blocks."""

    def inside(block, before):
        return F.transform(block, lambda x, i: before + total(F.slice(block, 1, i)))

    def over(blocks):
        return bind(F.transform(blocks, total), lambda sums: F.flatten(F.transform(blocks, lambda block, b: bind(total(F.slice(sums, 1, b)), lambda before: inside(block, before)))))

    return bind(numbers, lambda s: bind(in_blocks(s), over))


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as spans, with what lies before and behind. The gaps between matches give the places."""
    none = F.from_json(F.lit("[]"), f"array<struct<{SPAN.replace(' long', ':long').replace(' int', ':int').replace(' string', ':string')}>>")

    def spans(found, gaps):
        sizes = F.transform(found, lambda m, k: F.length(gaps[k]).cast("long") + F.length(m))
        return bind(
            sums_before(sizes),
            lambda before: F.transform(
                found,
                lambda m, k: bind(
                    before[k] + F.length(gaps[k]),
                    lambda start: F.struct(
                        start.alias("start"),
                        (start + F.length(m)).alias("finish"),
                        F.lit(KINDS.index(kind)).alias("kind"),
                        m.alias("text"),
                        F.right(gaps[k], F.lit(24)).alias("left"),
                        F.substring(gaps[k + 1], 1, 1).alias("after"),
                    ),
                ),
            ),
        )

    def some(found):
        return F.when(F.size(found) == 0, none).otherwise(bind(F.split(text, pattern, -1), lambda gaps: spans(found, gaps)))

    return F.when(text.rlike(NEEDS[kind]), bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), some)).otherwise(none)


def luhn(digits: Column) -> Column:
    def doubled(v):
        return v * 2 - F.when(v > 4, 9).otherwise(0)

    def value(i):
        return bind(F.substring(F.reverse(digits), i, F.lit(1)).cast("int"), lambda v: F.when(i % 2 == 0, doubled(v)).otherwise(v))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda t, i: t + value(i)) % 10 == 0


def holds(kind: str, text: Column) -> Column:
    """The contract's check of a match."""
    if kind == "ip":
        # three digits compare like their text, so that a part of any length is no number out of range
        return F.forall(F.split(text, r"\."), lambda p: bind(F.ltrim(p, F.lit("0")), lambda d: (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255"))))
    digits = F.regexp_replace(text, "[^0-9]", "")
    if kind == "card":
        return bind(digits, lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    return F.length(digits).between(8, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """Base spans of all kinds, by kind and start."""

    def checked(kind):
        return F.filter(matches(text, kind, BASE[kind]), lambda s: holds(kind, s["text"]))

    return F.concat(*map(checked, KINDS))


def covering(spans: Column) -> Column:
    """Spans in blocks by place, each with the range that it covers, so that overlaps are looked for in few blocks."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["finish"].alias("finish"), s["kind"].alias("kind"))))

    def block(b):
        return F.struct(b[0]["start"].alias("lo"), F.array_max(F.transform(b, lambda s: s["finish"])).alias("hi"), b.alias("spans"))

    return bind(ordered, lambda o: F.when(F.size(o) > 0, F.transform(in_blocks(o), block)))


def meets(span: Column, blocks: Column, also=None) -> Column:
    """Whether a span overlaps one of the blocks' spans, for which `also` holds."""

    def overlaps(s):
        hit = (s["start"] < span["finish"]) & (s["finish"] > span["start"])
        return hit if also is None else hit & also(s)

    found = F.exists(blocks, lambda b: (b["lo"] < span["finish"]) & (b["hi"] > span["start"]) & F.exists(b["spans"], overlaps))
    return F.coalesce(found, F.lit(False))


def kind_of_sign(sign: Column) -> Column:
    return F.when(sign == "", 0).otherwise(F.instr(F.lit(SIGNS), sign) + 1)


def kind_of_neighbour(sign: Column) -> Column:
    return F.when(sign == "", 0).when(sign.isin("\n", "\r"), 1).when(sign.rlike(r"\s"), 2).when(sign.rlike(r"\p{L}"), 3).when(sign.rlike("[0-9]"), 4).otherwise(5)


def features(span: Column) -> Column:
    """FEATURES of a proposal, each a small whole number."""
    head, tail = F.left(span["text"], F.lit(40)), F.right(span["text"], F.lit(40))
    signs = F.regexp_replace(span["text"], "[0-9A-Za-z]", "")
    before = F.regexp_replace(span["left"], r"\+?[0-9]{0,3} ?$", "")  # a country code would give the answer away
    context = F.coalesce(*(F.when(F.lower(span["left"]).rlike(words), k + 1) for k, words in enumerate(CONTEXT)), F.lit(0))
    return F.array(
        span["kind"],
        F.least(F.length(F.regexp_replace(span["text"], "[^0-9]", "")), F.lit(24)),
        F.least(F.length(span["text"]), F.lit(48)),
        F.least(F.length(signs), F.lit(12)),
        kind_of_sign(F.substring(signs, 1, 1)),
        kind_of_sign(F.right(signs, F.lit(1))),
        kind_of_neighbour(F.right(before, F.lit(1))),
        kind_of_neighbour(span["after"]),
        context,
        F.length(F.regexp_extract(head, "^[^0-9]*([0-9]*)", 1)),
        F.length(F.regexp_extract(tail, "([0-9]*)[^0-9]*$", 1)),
        F.least(F.length(F.regexp_replace(span["text"], "[^A-Za-z]", "")), F.lit(30)),
    )


def proposals(text: Column, base: Column) -> Column:
    """Wider spans: start, finish, kind, text, generator, x (features), own (meets a base span of its kind) and free (meets none)."""

    def proposal(s, generator, blocks):
        return F.struct(
            s["start"].alias("start"),
            s["finish"].alias("finish"),
            s["kind"].alias("kind"),
            s["text"].alias("text"),
            F.lit(generator).alias("generator"),
            features(s).alias("x"),
            meets(s, blocks, lambda b: b["kind"] == s["kind"]).alias("own"),
            (~meets(s, blocks)).alias("free"),
        )

    def from_one(generator, blocks):
        return F.transform(matches(text, *WIDE[generator]), lambda s: proposal(s, generator, blocks))

    def all_of(blocks):
        return F.concat(*(from_one(k, blocks) for k in range(len(WIDE))))

    return bind(covering(base), all_of)


def read(documents: DataFrame, text_column: str) -> DataFrame:
    """The rows with a column __found of base spans and proposals, computed once (the explode of one element sees to that)."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    both = bind(base_spans(text), lambda base: F.struct(base.alias("base"), proposals(text, base).alias("wide")))
    return documents.select("*", F.explode(F.array(both)).alias("__found"))


@dataclass(frozen=True)
class Model:
    """Trees as (feature, threshold, (feature, threshold, value, value) twice), the first score, and a threshold for each kind (None: nothing is added)."""

    start: float
    trees: tuple
    thresholds: tuple[float | None, ...]

    def score(self, x: Column) -> Column:
        return score(self.start, self.trees, x)


def tree_value(tree: tuple, x: Column) -> Column:
    feature, limit, low, high = tree

    def side(f, at, left, right):
        return F.when(x[f] <= at, F.lit(left)).otherwise(F.lit(right))

    return F.when(x[feature] <= limit, side(*low)).otherwise(side(*high))


def score(start: float, trees, x: Column) -> Column:
    margin = sum((tree_value(t, x) for t in trees), F.lit(start))
    return 1 / (1 + F.exp(-margin))


def best_split(counted: dict) -> tuple[float, int, int, float, float]:
    """(gain, feature, threshold, values of both leaves) from sums of gradients and curvatures by (feature, value)."""
    best = None
    by_feature: dict[int, list] = {}
    for (f, v), (g, h) in counted.items():
        by_feature.setdefault(f, []).append((v, g, h))
    for f, rows in sorted(by_feature.items()):
        rows.sort()
        g_all, h_all = math.fsum(r[1] for r in rows), math.fsum(r[2] for r in rows)
        g = h = 0.0
        for v, dg, dh in rows:
            g, h = g + dg, h + dh
            gain = g * g / (h + PRIOR) + (g_all - g) ** 2 / (h_all - h + PRIOR) - g_all**2 / (h_all + PRIOR)
            if best is None or round(gain, 9) > best[0]:
                best = (round(gain, 9), f, v, RATE * g / (h + PRIOR), RATE * (g_all - g) / (h_all - h + PRIOR))
    return best or (0.0, 0, 0, 0.0, 0.0)


def boosted(examples: DataFrame, rounds: int) -> tuple[float, tuple]:
    """Newton boosting on (x, n, own) rows. What the driver gets is bounded: sums by side, feature and value."""
    n, own = examples.agg(F.sum("n"), F.sum("own")).first()
    if not n or not own or own == n:
        return (0.0, ())
    start, trees = math.log(own / (n - own)), ()

    def counted(parts: Column | None):
        p = score(start, trees, F.col("x"))
        sloped = examples.select((F.lit(0) if parts is None else parts).alias("part"), (F.col("own") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"), F.posexplode("x").alias("f", "v"))
        out: dict[int, dict] = {0: {}, 1: {}}
        for r in sloped.groupBy("part", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            out[r["part"]][r["f"], r["v"]] = (r["g"], r["h"])
        return out

    for _ in range(rounds):
        gain, feature, limit, _, _ = best_split(counted(None)[0])
        if gain <= 0:
            break
        sides = counted((F.col("x")[feature] > limit).cast("int"))
        trees += ((feature, limit, *(best_split(sides[k])[1:] for k in (0, 1))),)
    return start, trees


def calibrated(rows: list[tuple[float, int, int]], precision: float, support: int) -> float | None:
    """The least score from which on held-out proposals are right often enough: rates by score are made monotone by pooling neighbours."""
    pooled: list[list[float]] = []
    for at, n, own in sorted(rows):
        pooled.append([at, n, own])
        while len(pooled) > 1 and pooled[-2][2] * pooled[-1][1] >= pooled[-1][2] * pooled[-2][1]:
            _, n2, own2 = pooled.pop()
            pooled[-1][1] += n2
            pooled[-1][2] += own2
    good = [p for p in pooled if p[2] >= precision * p[1]]
    return good[0][0] if good and sum(p[1] for p in good) >= support else None


def train(documents: DataFrame, text_column: str = "text", rounds: int = ROUNDS, precision: float = PRECISION, support: int = SUPPORT) -> Model:
    """Trees and thresholds from all documents. Without any example (an empty table, say) the model adds nothing."""
    wide = read(documents.select(text_column), text_column).select(F.explode("__found.wide").alias("w"))
    rows = wide.select("w.x", (F.pmod(F.xxhash64("w.text"), F.lit(4)) == 0).alias("held"), F.col("w.own").cast("long").alias("own"))
    counted = materialize(rows.groupBy("x", "held").agg(F.count("*").alias("n"), F.sum("own").alias("own")), "proposals")
    start, trees = boosted(counted.where(~F.col("held")), rounds)
    if not trees:
        return Model(start, (), (None,) * len(KINDS))
    scored = counted.where("held").select(F.col("x")[0].alias("kind"), F.round(score(start, trees, F.col("x")), 3).alias("score"), "n", "own")
    by_kind: dict[int, list] = {}
    for r in scored.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum("own").alias("own")).collect():
        by_kind.setdefault(r["kind"], []).append((r["score"], r["n"], r["own"]))
    return Model(start, trees, tuple(calibrated(by_kind.get(k, []), precision, support) for k in range(len(KINDS))))


def added(wide: Column, model: Model) -> Column:
    """Proposals that meet no base span and score enough; of two that overlap, the better one (then the earlier generator's) stays."""
    limits = [(k, t) for k, t in enumerate(model.thresholds) if t is not None]
    if not limits:
        return F.filter(wide, lambda w: F.lit(False))
    scored = F.transform(F.filter(wide, lambda w: w["free"]), lambda w: w.withField("score", F.round(model.score(w["x"]), 3)))
    enough = F.filter(scored, lambda w: F.coalesce(*(F.when(w["kind"] == k, w["score"] >= t) for k, t in limits), F.lit(False)))

    def alone(all_of):
        keyed = F.transform(all_of, lambda w: F.struct(w["start"].alias("start"), w["finish"].alias("finish"), F.struct((-w["score"]).alias("s"), w["generator"].alias("g")).alias("kind")))
        return bind(covering(keyed), lambda blocks: F.filter(all_of, lambda w: ~meets(w, blocks, lambda b: b["kind"] < F.struct((-w["score"]).alias("s"), w["generator"].alias("g")))))

    return bind(enough, lambda e: F.when(F.size(e) > 0, alone(e)).otherwise(e))


def plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["finish"].alias("finish")))


def find_personal(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows with `base_spans` and `spans` (base and added): arrays of (kind, start, finish), by kind and start.

    Kinds are places in KINDS, positions count code points, finish is exclusive. Columns of these names are replaced.
    """
    kept = [c for c in documents.columns if c not in ("base_spans", "spans")]
    found = read(documents.select(*kept), text_column)
    all_spans = F.array_sort(F.concat(plain(F.col("__found.base")), plain(added(F.col("__found.wide"), model))))
    return found.select(*kept, plain(F.col("__found.base")).alias("base_spans"), all_spans.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap become one, named after the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["finish"].alias("finish"), s["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))

    def step(done, s):
        gap = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.when(s["start"] < done["at"], F.struct(F.greatest(done["at"], s["finish"]).alias("at"), done["out"].alias("out"))).otherwise(
            F.struct(s["finish"].alias("at"), F.concat(done["out"], gap, names[s["kind"]]).alias("out"))
        )

    return F.aggregate(ordered, empty, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))


def written(spans: Column) -> Column:
    """kind:start:finish, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["finish"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
