"""Line dedup by a segment-partition edit join, in DataFrame and SQL functions only.

Lines of at least `min_chars` characters take part. A line is removed if the same line stands earlier (by document, then
place), or a line within `distance` edits whose first occurrence is earlier. Shorter lines are left alone.

Equal lines are one class, known by a 128-bit hash. For the edit join each distinct line is cut into distance + 1 segments, of
even length: `distance` edits leave one of them whole, so a line within reach holds that segment at a place that the edits
left and right of it bound. Each line indexes its segments (hashed with their number and the line's length) and probes with
its substrings for its own length and each shorter one within the distance. Probes and index entries meet by equal keys, and the
counts of a few letters (an edit changes two counts by one at most) refuse most of what is too far, in the join. Texts are
then fetched for the lines that are left (spread over all tasks, as few of them may cost a lot), and verified by a banded bit-parallel automaton: one bit for each diagonal of the
band and one word for each number of edits, a few operations for each character.

Only hashes and numbers are exploded and shuffled by line; whole texts are read, and joined once with the places to remove. A
line that repeats a lot is folded into its class before anything is joined. Near lines are paired class by class.

Lines made from one template share a segment by the thousands and are mostly far apart. At a distance of one, a segment that more
than HOT lines index joins nothing: the lines that have it meet by what is left of them without one character, so that
only lines within reach meet. A pair without any other common segment has both its lines there, so none is lost. At larger distances a
shared segment joins all its lines.

Null texts have no lines and stay null. Rows equal in id and text stand for one document: they keep the same lines. Null
ids come first in the order of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adit.session import materialize

MIN_CHARS = 20
DISTANCE = 1
#: Letters whose counts refuse lines; counts wrap at 128.
COUNTED = "eantoisr"
COUNT_BITS = 7
#: Lines to verify up to which their hashes (8 bytes each) are broadcast to fetch the texts; above, Spark joins as it sees fit.
BROADCAST_LINES = 1 << 20
#: Lines that may index one segment before they are joined by their parts instead (at a distance of one). Parts are some two rows a
#: character, so below some thousand lines the segment itself is the cheaper key.
HOT = 2048


def documents(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("print")
    )


def exploded(docs: DataFrame, min_chars: int) -> DataFrame:
    """Lines that take part: doc, print, place, line, and the hashes h and g."""
    lines = docs.select("doc", "print", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return lines.where(F.length("line") >= min_chars).select("doc", "print", "place", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit("g"), "line").alias("g"))


def letter_counts(line: Column) -> Column:
    """How often each of COUNTED stands in the line, packed into one number."""
    packed = F.lit(0).cast("long")
    for k, letter in enumerate(COUNTED):
        count = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        packed = packed.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit((1 << COUNT_BITS) - 1)), COUNT_BITS * k))
    return packed


def apart(a: Column, b: Column) -> Column:
    """Sum of the differences of the letters' counts, the short way round where they wrap: at most two for each edit."""
    total, size = F.lit(0), 1 << COUNT_BITS
    for k in range(len(COUNTED)):
        x, y = (F.shiftright(c, COUNT_BITS * k).bitwiseAND(F.lit(size - 1)) for c in (a, b))
        gap = F.abs(x - y)
        total = total + F.least(gap, F.lit(size) - gap)
    return total


def segment(length: Column, number: int, parts: int) -> tuple[Column, Column]:
    """(first character, from 1; characters) of a segment, counted from 0, of a line of that length: the last ones are longer by one where it does not divide."""
    short = F.floor(length / parts).cast("int")
    longer = F.greatest(F.lit(0), F.lit(number - parts) + length % parts)  # longer segments before this one
    return F.lit(number) * short + longer + 1, short + F.when(F.lit(number) >= F.lit(parts) - length % parts, 1).otherwise(0)


def keys(distance: int) -> tuple[Column, Column]:
    """Arrays of the keys that a line indexes, and of those it probes beside its own: (key, length of the other line)."""
    line, n, parts = F.col("line"), F.length("line"), distance + 1
    indexed, probed = [], []
    for shorter in range(distance + 1):
        other = n - shorter
        for i in range(parts):
            first, size = segment(other, i, parts)
            # edits left of the segment and right of it share the distance: i before at most, distance - i after
            for shift in range(max(-i, shorter - (distance - i)), min(i, shorter + (distance - i)) + 1):
                key = F.xxhash64(F.substring(line, first + shift, size), other, F.lit(i))
                (indexed if shorter == shift == 0 else probed).append(key)
    return F.array(*indexed), F.array(*probed)


def within(a: Column, b: Column, distance: int) -> Column:
    """Whether two texts are within the distance: bit t of word e says that a's first j characters and b's first j + t - distance
    are within e edits; each character of a moves all of them on."""
    width = 2 * distance + 1
    mask, start = (1 << width) - 1, [sum(1 << t for t in range(distance, distance + e + 1)) for e in range(distance + 1)]
    x, y = F.slice(F.split(a, ""), 1, F.length(a)), F.split(b, "")  # an empty text splits into one empty part

    def equal(character: Column, j: Column) -> Column:
        """Bits of the diagonals on which b has this character."""
        bits = F.lit(0)
        for t in range(width):
            bits = bits + F.when(F.get(y, j + (t - distance)) == character, 1 << t).otherwise(0)
        return bits

    def step(state: Column, same: Column) -> Column:
        now = [state["r0"].bitwiseAND(same)]
        for e in range(1, distance + 1):
            before = state[f"r{e - 1}"]
            now.append(
                state[f"r{e}"].bitwiseAND(same).bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(now[e - 1], 1)).bitwiseAND(F.lit(mask))
            )  # alike; another character; one of a's is left out; one of b's is left out
        return F.struct(*(r.alias(f"r{e}") for e, r in enumerate(now)))

    first = F.struct(*(F.lit(s).alias(f"r{e}") for e, s in enumerate(start)))
    end = F.length(b) - F.length(a) + distance
    last = F.aggregate(F.transform(x, equal), first, step, lambda s: s[f"r{distance}"])
    return (F.abs(F.length(b) - F.length(a)) <= distance) & (F.getbit(last.cast("long"), end) == 1)


def line_classes(lines: DataFrame, distance: int) -> DataFrame:
    """One row for each distinct line: h, g, times, first occurrence, and the keys, length and counts for the join. No texts."""
    indexed, probed = keys(distance)
    at = F.struct("doc", "print", "place")
    seen = lines.select("h", "g", at.alias("at"), F.length("line").alias("n"), letter_counts(F.col("line")).alias("counts"), indexed.alias("indexed"), probed.alias("probed"))
    return materialize(
        seen.groupBy("h", "g").agg(
            F.count("*").alias("times"), F.min("at").alias("first"), F.first("n").alias("n"), F.first("counts").alias("counts"), F.first("indexed").alias("indexed"), F.first("probed").alias("probed")
        ),
        "line-classes",
    )


def one_apart(lines: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct lines (h, line) within one edit, by equal hashes of lines without one character."""
    n = F.length("line")
    without = lambda p: F.concat(F.substring(F.col("line"), F.lit(1), p - 1), F.substring(F.col("line"), p + 1, n))
    cut = F.explode(F.transform(F.sequence(F.lit(1), n), lambda p: F.struct(p.alias("p"), F.xxhash64(without(p)).alias("key"))))
    parts = lines.select("h", n.alias("n"), cut.alias("cut")).select("h", "n", "cut.*")
    left, right = (parts.select(F.col("h").alias(x), "n", "p", "key") for x in "ab")
    replaced = left.join(right, ["key", "p", "n"]).where("a < b").select("a", "b")  # the same place holds another character
    shorter = lines.select(F.col("h").alias("a"), (n + 1).alias("n"), F.xxhash64("line").alias("key"))
    return replaced.union(shorter.join(parts.select(F.col("h").alias("b"), "n", "key"), ["key", "n"]).where("a <> b").select("a", "b"))


def near_lines(lines: DataFrame, classes: DataFrame, distance: int) -> DataFrame:
    """Links between different lines within the distance, both ways: h, g, first, and first of the other as other_first."""
    index = classes.select(F.explode("indexed").alias("key"), F.col("h").alias("a"), F.col("n").alias("a_n"), F.col("counts").alias("a_counts"))
    probes = classes.select(F.explode(F.concat("indexed", "probed")).alias("key"), F.col("h").alias("b"), F.col("n").alias("b_n"), F.col("counts").alias("b_counts"))
    close = (F.col("b_n") - F.col("a_n")).between(0, distance) & (apart(F.col("a_counts"), F.col("b_counts")) <= 2 * distance)
    once = (F.col("b_n") > F.col("a_n")) | (F.col("a") < F.col("b"))  # lines of one length meet from both sides
    beside = None
    if distance == 1:
        hot = materialize(index.groupBy("key").count().where(F.col("count") > HOT).select("key"), "hot-segments")
        if hot.head(1):
            whose = materialize(probes.join(hot, "key", "left_semi").select(F.col("b").alias("h")).distinct(), "hot-lines")
            texts = lines.select("h", "g", "line").join(whose, "h", "left_semi").groupBy("h", "g").agg(F.first("line").alias("line"))
            beside = one_apart(materialize(texts, "hot-texts").select("h", "line"))
            index = index.join(hot, "key", "left_anti")
    found = index.join(probes, "key").where(close & once & (F.col("a") != F.col("b"))).select("a", "b")
    pairs = materialize((found if beside is None else found.union(beside)).distinct(), "line-pairs")

    wanted = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b").alias("h"))).distinct()
    few = wanted.count() <= BROADCAST_LINES
    texts = lines.join(F.broadcast(wanted) if few else wanted, "h").groupBy("h", "g").agg(F.first("line").alias("line"), F.min(F.struct("doc", "print", "place")).alias("first"))
    texts = materialize(texts, "line-texts")
    side = lambda p: texts.select(*(F.col(c).alias(f"{p}_{c}") for c in ("h", "g", "line", "first")))
    both = [f"{p}_{c}" for p in "ab" for c in ("h", "g", "line", "first")]
    met = pairs.join(side("a"), F.col("a") == F.col("a_h")).join(side("b"), F.col("b") == F.col("b_h")).select(*both)
    # few pairs may cost a lot: they are dealt to all tasks, and the explode of one element keeps the check behind that
    dealt = met.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a_h", "b_h").select(F.explode(F.array(F.struct(*both))).alias("x"))
    linked = dealt.where(within(F.col("x.a_line"), F.col("x.b_line"), distance)).select("x.a_h", "x.a_g", "x.a_first", "x.b_h", "x.b_g", "x.b_first").distinct()
    linked = materialize(linked, "line-links")
    way = lambda p, q: linked.select(F.col(f"{p}_h").alias("h"), F.col(f"{p}_g").alias("g"), F.col(f"{p}_first").alias("first"), F.col(f"{q}_first").alias("other_first"))
    return way("a", "b").union(way("b", "a"))


def dedup_lines(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The frame with kept_text instead of the text column, and n_lines, n_removed and n_links (other distinct lines within
    the distance, summed over the lines that take part), last."""
    if min_chars <= distance:
        raise ValueError("lines that take part must be longer than the distance")
    named = documents(docs, text, id_column)
    lines = exploded(named, min_chars)
    classes = line_classes(lines, distance)
    links = near_lines(lines, classes, distance).groupBy("h", "g").agg(F.count("*").alias("links"), F.max(F.col("other_first") < F.col("first")).alias("near_earlier"))
    marks = (
        classes.select("h", "g", "times", "first").join(links, ["h", "g"], "left")
        .where((F.col("times") > 1) | F.col("links").isNotNull())
        .select("h", "g", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("near_earlier", F.lit(False)).alias("near_earlier"))
    )
    gone = F.col("near_earlier") | (F.struct("doc", "print", "place") != F.col("first"))
    places = (
        lines.drop("line").distinct().join(marks, ["h", "g"])
        .groupBy("doc", "print")
        .agg(F.sort_array(F.collect_list(F.when(gone, F.col("place")))).alias("gone"), F.sum("links").alias("n_links"))
    )
    clash = ["kept_text", "n_lines", "n_removed", "n_links"]
    rest = [c for c in docs.columns if c != text and c not in clash]
    keyed = docs.select(
        F.struct(*rest).alias("row"), F.split(text, "\n").alias("lines"), F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("print")
    )
    joined = keyed.join(places, ["doc", "print"], "left")
    none = F.col("gone").isNull() | (F.size("gone") == 0)
    kept = F.when(none, F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~F.array_contains(F.col("gone"), i)))
    told = joined.select(
        "row", F.array_join(kept, "\n").alias("kept_text"), F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    return told.select(*[F.col("row").getField(c).alias(c) for c in rest], "kept_text", "n_lines", "n_removed", "n_links")
