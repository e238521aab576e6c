"""X-, R- and W-keys that read text: lines, sentences, blocks, tables, matches and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.functions import text as T
from adit.operators import extract as X
from adit.operators import routing as R
from suite.base import load, load_spread, query

# Word lists for the driver's invented prose.
EVENT_WORDS = ("eau", "sch", "ción", "tion")
HYPOTHESES = (
    ("H1", ("ering", "heed")),
    ("H2", ("eau", "çr")),
    ("H3", ("sch", "und")),
    ("H4", ("ción", "ando")),
    ("H5", ("tion",)),
)

SQL_LINES = """lines AS (SELECT doc_id, lang, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no,
    unnest(string_split(text, chr(10))) AS line FROM documents)"""

WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_sentences(min_len: int, source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return rf"""sent AS (SELECT {key}, pos, sentence FROM (
        SELECT {key}, generate_subscripts(p, 1) - 1 AS raw_pos, unnest(p) AS sentence, unnest(q) AS pos FROM (
          SELECT {key}, p, [i - 1 FOR i IN generate_series(1, len(p))] AS q FROM (
            SELECT {key}, list_filter(list_transform(string_split_regex(regexp_replace({text}, '={{70,}}|-{{70,}}', '', 'g'), '[.!?]'),
              lambda s: regexp_replace(s, '^{WS}+|{WS}+$', '', 'g')), lambda s: length(s) > {min_len}) AS p FROM {source}))))"""


def documents(spark, sf):
    return load_spread(spark, sf, "documents").select("doc_id", "text")


@query("lines", f"WITH {SQL_LINES} SELECT doc_id, line_no, md5(line) AS h FROM lines")
def lines(spark, sf):
    return X.to_lines(documents(spark, sf)).select("doc_id", F.col("line_no").cast("bigint"), F.md5("line").alias("h"))


@query("sentences", f"WITH {sql_sentences(20)} SELECT doc_id, pos, md5(sentence) AS h FROM sent")
def sentences(spark, sf):
    return X.to_sentences(documents(spark, sf), 20).select("doc_id", F.col("pos").cast("bigint"), F.md5("sentence").alias("h"))


@query(
    "keyword_events",
    f"WITH {sql_sentences(10)} SELECT doc_id, pos, md5(sentence) AS h FROM sent WHERE regexp_matches(lower(sentence), 'eau|sch|ción|tion')",
)
def keyword_events(spark, sf):
    return X.keyword_events(documents(spark, sf), EVENT_WORDS, 10).select(
        "doc_id", F.col("pos").cast("bigint"), F.md5("sentence").alias("h")
    )


# Tables written from nations and regions, with rulers, border variants, totals and a second header.
NATION_TABLE = X.TableLayout(
    header_words=("Код", "Название", "Регион", "Номер"),
    columns=(("region", ("регион",)), ("name", ("названи",)), ("code", ("код", "номер"))),
    skip_words=("Итого",),
)


def nation_docs(spark, sf):
    """One document per customer, with two tables: its nation row and its account row, under different headers."""
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    wide = (
        load(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    text = F.concat_ws(
        "\n",
        F.lit("=" * 80),
        F.concat(F.lit("Справка | "), F.col("c_name")),
        F.lit("| Код | Название | Регион |"),
        F.lit("|-----|----------|--------|"),
        F.concat(F.lit("| "), F.col("n_nationkey").cast("string"), F.lit(" | "), F.col("n_name"), F.lit(" | "), F.col("r_name"), F.lit(" |")),
        F.lit("| Итого | 1 | |"),
        F.lit("текст между таблицами"),
        F.lit("Регион | Номер | Название"),
        F.lit("-------|-------|---------"),
        F.concat(F.lit("| "), F.lit(" | "), F.col("c_custkey").cast("string"), F.lit(" | "), F.col("c_mktsegment")),
    )
    return wide.select("c_custkey", text.alias("text"))


_NATION_SQL = """SELECT c_custkey, CAST(1 AS BIGINT) AS table_no, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT c_custkey, 2, CAST(c_custkey AS VARCHAR), c_mktsegment, NULL FROM customer"""


@query("pipe_table", _NATION_SQL)
def pipe_table(spark, sf):
    return X.pipe_table(nation_docs(spark, sf), NATION_TABLE).select(
        "c_custkey", F.col("table_no").cast("bigint"), "code", "name", "region"
    )


@query(
    "table_row_filter",
    r"""WITH p AS (SELECT page_id, unnest(string_split(replace(replace(html, '<', chr(10) || '|'), '>', '|'), chr(10))) AS line FROM pages)
        SELECT page_id, count(*) AS rows, CAST(sum(length(line)) AS BIGINT) AS chars FROM p
        WHERE contains(line, '|') AND NOT regexp_matches(line, '^[\s|=*:+-]*$') AND NOT contains(line, 'div') GROUP BY page_id""",
)
def table_row_filter(spark, sf):
    text = F.replace(F.replace("html", F.lit("<"), F.lit("\n|")), F.lit(">"), F.lit("|"))
    rows = X.to_lines(load_spread(spark, sf, "pages").select("page_id", text.alias("text")))
    return (
        rows.where(X.is_table_row(F.col("line"), ("div",)))
        .groupBy("page_id")
        .agg(F.count("*").alias("rows"), F.sum(F.length("line")).alias("chars"))
    )


PAGE_FIELDS = {
    "title": [r"<h1>([^<\n]*)", r"<title>([^<\n]*)"],
    "lang": [r'<html lang="([a-z]+)"', r'lang=([a-z]+)'],
    "link": [r'<article>.*?href="([^"\n]+)"', r'href="([^"\n]+)"'],
}


@query(
    "first_match",
    rf"""SELECT page_id,
         coalesce(nullif(regexp_replace(regexp_extract(html, '<h1>([^<\n]*)', 1), '^{WS}+|{WS}+$', '', 'g'), ''),
                  nullif(regexp_replace(regexp_extract(html, '<title>([^<\n]*)', 1), '^{WS}+|{WS}+$', '', 'g'), '')) AS title,
         coalesce(nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), ''), nullif(regexp_extract(html, 'lang=([a-z]+)', 1), '')) AS lang,
         coalesce(nullif(regexp_extract(html, '<article>.*?href="([^"\n]+)"', 1), ''), nullif(regexp_extract(html, 'href="([^"\n]+)"', 1), '')) AS link
         FROM pages""",
)
def first_match(spark, sf):
    return X.labelled_fields(load_spread(spark, sf, "pages").select("page_id", F.col("html").alias("text")), PAGE_FIELDS)


@query(
    "all_matches",
    r"""WITH h AS (SELECT page_id, list_concat(regexp_extract_all(html, 'href="([^"]+)"', 1), regexp_extract_all(html, '<([a-z0-9]+)[ >]', 1)) AS m FROM pages),
        u AS (SELECT page_id, unnest(m) AS match, generate_subscripts(m, 1) AS i FROM h)
        SELECT page_id, match, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS BIGINT) AS pos FROM u GROUP BY page_id, match""",
)
def all_matches(spark, sf):
    pages = load_spread(spark, sf, "pages").select("page_id", F.col("html").alias("text"))
    return X.all_matches(pages, [r'href="([^"]+)"', r"<([a-z0-9]+)[ >]"]).select(
        "page_id", "match", F.col("pos").cast("bigint")
    )


@query(
    "split_blocks",
    """WITH b AS (SELECT page_id, string_split(replace(html, '<li>', chr(1) || '<li>'), chr(1)) AS p FROM pages),
       u AS (SELECT page_id, unnest(p) AS block, generate_subscripts(p, 1) - 1 AS block_no FROM b)
       SELECT page_id, block_no, regexp_extract(block, 'href="/([^"]*)"', 1) AS head_link, length(block) AS chars FROM u WHERE block_no > 0""",
)
def split_blocks(spark, sf):
    text = F.replace("html", F.lit("<li>"), F.lit("\n<li>"))
    blocks = X.split_blocks(load_spread(spark, sf, "pages").select("page_id", text.alias("text")), "<li>")
    joined = F.concat("head", F.when(F.col("body") != "", F.concat(F.lit("\n"), "body")).otherwise(F.lit("")))
    return blocks.select(
        "page_id",
        F.col("block_no").cast("bigint"),
        F.regexp_extract("head", r'href="/([^"]*)"', 1).alias("head_link"),
        F.length(joined).cast("bigint").alias("chars"),
    )


def section_text(prefix=""):
    """A document's lines with marker lines chosen by their length, so that sections open and close."""
    line = lambda x: F.when(F.length(x) % 7 == 0, F.concat(F.lit("ЗОНА А "), x)).when(
        F.length(x) % 11 == 0, F.concat(F.lit("ВНЕ ЗОНЫ "), x)
    ).otherwise(x)
    return F.array_join(F.transform(F.split("text", "\n", -1), line), "\n")


@query(
    "section_state",
    f"""WITH {SQL_LINES}, m AS (SELECT *, CASE WHEN length(line) % 7 = 0 THEN 'A' WHEN length(line) % 11 = 0 THEN '-' END AS mark FROM lines),
       s AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS state FROM m)
       SELECT doc_id, 'A' AS state, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM s WHERE mark IS NULL AND state = 'A' GROUP BY doc_id""",
)
def section_state(spark, sf):
    docs = documents(spark, sf).select("doc_id", section_text().alias("text"))
    inside = X.sections(docs, [("ЗОНА А ", "A"), ("ВНЕ ЗОНЫ ", None)])
    return inside.groupBy("doc_id", "state").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query(
    "header_carry",
    f"""WITH {SQL_LINES}, m AS (SELECT *, CASE WHEN length(line) % 9 = 0 THEN line_no END AS h FROM lines),
       s AS (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS head_no FROM m)
       SELECT doc_id, CAST(length(line) AS BIGINT) AS size, CASE WHEN head_no % 2 = 0 THEN 'even' ELSE 'odd' END AS header, count(*) AS n
       FROM s WHERE h IS NULL AND head_no IS NOT NULL AND line <> '' GROUP BY 1, 2, 3""",
)
def header_carry(spark, sf):
    """Each data line is read with the header above it: two headers that swap the columns."""
    raw = F.split("text", "\n", -1)
    line = F.transform(
        raw,
        lambda x, i: F.when(
            F.length(x) % 9 == 0,
            F.when(i % 2 == 0, "| Размер | Вид |").otherwise("| Вид | Размер |"),
        ).otherwise(F.concat(F.lit("| "), F.length(x).cast("string"), F.lit(" | "), F.length(x).cast("string"), F.lit(" |"))),
    )
    docs = documents(spark, sf).select("doc_id", F.array_join(line, "\n").alias("text"))
    layout = X.TableLayout(("Размер", "Вид"), (("size", ("размер",)), ("kind", ("вид",))))
    rows = X.pipe_table(docs.withColumn("heads", F.filter(F.split("text", "\n"), lambda x: x.contains("Вид"))), layout)
    header = F.element_at("heads", F.col("table_no"))
    return (
        rows.where("size <> '0'")
        .select(
            "doc_id",
            F.col("size").cast("bigint").alias("size"),
            F.when(header.startswith("| Размер"), "even").otherwise("odd").alias("header"),
        )
        .groupBy("doc_id", "size", "header")
        .agg(F.count("*").alias("n"))
    )


@query(
    "timestamp_blocks",
    f"""WITH {SQL_LINES}, c AS (SELECT doc_id, line_no, CASE WHEN line_no % 5 = 0 THEN line_no END AS mark,
          trim(regexp_replace(regexp_replace(line, '[0-9:]', '', 'g'), '{WS}+', ' ', 'g'), ' ') AS t FROM lines),
        s AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS head FROM c),
        w AS (SELECT doc_id, head, trim(regexp_replace(string_agg(t, ' ' ORDER BY line_no), ' +', ' ', 'g'), ' ') AS body FROM s WHERE mark IS NULL GROUP BY doc_id, head)
        SELECT doc_id, lpad(CAST(head % 24 AS VARCHAR), 2, '0') || CASE WHEN head % 2 = 0 THEN ':15:00' ELSE ':05:00' END AS clock, md5(body) AS h FROM w WHERE body <> ''""",
)
def timestamp_blocks(spark, sf):
    """Documents as transcripts: every fifth line becomes a time mark, in one of two spellings."""
    hour = lambda i: (i % 24).cast("string")

    def said(x, i):
        mark = F.when(i % 2 == 0, F.concat(F.lit("Начало "), F.lpad(hour(i), 2, "0"), F.lit(":15:00"))).otherwise(
            F.concat(F.lit("Запись "), hour(i), F.lit(" ч 5 мин"))
        )
        return F.when(i % 5 == 0, mark).otherwise(F.trim(F.regexp_replace(F.regexp_replace(x, "[0-9:]", ""), f"{T.SPACE}+", " ")))

    docs = documents(spark, sf).select("doc_id", F.array_join(F.transform(F.split("text", "\n", -1), said), "\n").alias("text"))
    return X.timestamp_blocks(docs).select("doc_id", "clock", F.md5("body").alias("h"))


@query(
    "numbered_items",
    f"""WITH {SQL_LINES} SELECT doc_id, line_no, md5(regexp_replace(line, '^{WS}+|{WS}+$', '', 'g')) AS h FROM lines
        WHERE line_no % 3 = 1 AND regexp_matches(line, '^\\s*\\S')""",
)
def numbered_items(spark, sf):
    line = F.transform(
        F.split("text", "\n", -1), lambda x, i: F.when(i % 3 == 1, F.concat(i.cast("string"), F.lit(". "), x)).otherwise(F.concat(F.lit("- "), x))
    )
    docs = documents(spark, sf).select("doc_id", F.array_join(line, "\n").alias("text"))
    return X.numbered_items(X.to_lines(docs)).select("doc_id", F.col("line_no").cast("bigint"), F.md5("item").alias("h"))


@query(
    "bullet_facts",
    f"""WITH {SQL_LINES}, t AS (SELECT doc_id, line_no, regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') AS line FROM lines)
        SELECT doc_id, md5(line) AS h, count(*) AS n FROM t WHERE length(line) >= 10 GROUP BY doc_id, md5(line)""",
)
def bullet_facts(spark, sf):
    line = F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit("   - "), F.regexp_replace(x, r"^[\s•-]+(?=[-•]\s)", "")))
    docs = documents(spark, sf).select("doc_id", F.concat(F.lit("Осмотрено:\n"), F.array_join(line, "\n")).alias("body"))
    return X.bullet_facts(docs).groupBy("doc_id", F.md5("fact").alias("h")).agg(F.count("*").alias("n"))


# Routing over page addresses.
PAGE_RULES = (
    (("*blog*",), "blog", 10),
    (("*/fr/*", "*/fr"), "french", 10),
    (("*shop*",), "shop", 10),
    (("*blog*5*", "*shop*5*"), "fives", 10),
    (("*/fr/*page*",), "experiment", 10),
    (("*?ref=x", "*news*"), "tracked", 10),
)
PAGE_WORDS = (("english", ("/en/", "the")), ("numbers", ("7", "8")))
REGISTERED = ("blog", "french", "shop", "fives", "tracked")

_FILES_SQL = "files AS (SELECT page_id, regexp_replace(lower(regexp_replace(url, '^[a-z]+://', '')), '[?#].*$', '') || CASE WHEN page_id % 9 = 0 THEN '?ref=x' ELSE '' END AS file_name FROM pages)"
_RULES_SQL = """routed AS (
    SELECT page_id, file_name, 'blog' AS target, 10 AS priority FROM files WHERE file_name LIKE '%blog%'
    UNION ALL SELECT page_id, file_name, 'french', 10 FROM files WHERE file_name LIKE '%/fr/%' OR file_name LIKE '%/fr'
    UNION ALL SELECT page_id, file_name, 'shop', 10 FROM files WHERE file_name LIKE '%shop%'
    UNION ALL SELECT page_id, file_name, 'fives', 10 FROM files WHERE file_name LIKE '%blog%5%' OR file_name LIKE '%shop%5%'
    UNION ALL SELECT page_id, file_name, 'experiment', 10 FROM files WHERE file_name LIKE '%/fr/%page%'
    UNION ALL SELECT page_id, file_name, 'tracked', 10 FROM files WHERE file_name LIKE '%_ref=x' OR file_name LIKE '%news%')"""


def page_files(spark, sf):
    bare = F.regexp_replace(F.lower(F.regexp_replace("url", "^[a-z]+://", "")), "[?#].*$", "")
    return load_spread(spark, sf, "pages").select(
        "page_id", F.concat(bare, F.when(F.col("page_id") % 9 == 0, "?ref=x").otherwise("")).alias("file_name")
    )


@query("route_files", f"WITH {_FILES_SQL}, {_RULES_SQL} SELECT page_id, file_name, target, priority FROM routed")
def route_files(spark, sf):
    return R.route_files(page_files(spark, sf), PAGE_RULES)


@query(
    "route_registered",
    f"WITH {_FILES_SQL}, {_RULES_SQL} SELECT target, count(*) AS files FROM routed WHERE target <> 'experiment' GROUP BY target",
)
def route_registered(spark, sf):
    rules = R.registered_only(PAGE_RULES, REGISTERED)
    return R.route_files(page_files(spark, sf), rules).groupBy("target").agg(F.count("*").alias("files"))


@query(
    "route_fallback",
    f"""WITH {_FILES_SQL}, {_RULES_SQL},
       rest AS (SELECT * FROM files WHERE page_id NOT IN (SELECT page_id FROM routed)),
       words AS (SELECT page_id, file_name, 'english' AS target, 0 AS priority FROM rest WHERE contains(file_name, '/en/') OR contains(file_name, 'the')
                 UNION ALL SELECT page_id, file_name, 'numbers', 0 FROM rest WHERE contains(file_name, '7') OR contains(file_name, '8'))
       SELECT * FROM routed UNION ALL SELECT * FROM words
       UNION ALL SELECT page_id, file_name, 'hypothesis_facts', -1 FROM rest WHERE page_id NOT IN (SELECT page_id FROM words)""",
)
def route_fallback(spark, sf):
    return R.route_with_fallback(page_files(spark, sf), PAGE_RULES, PAGE_WORDS, "hypothesis_facts")


@query(
    "choose_variant",
    f"""WITH {_FILES_SQL} SELECT CASE WHEN contains(file_name, 'blog') OR contains(file_name, 'news') THEN 'log'
        WHEN contains(file_name, 'shop') THEN 'order' ELSE 'generic' END AS variant, count(*) AS files FROM files GROUP BY 1""",
)
def choose_variant(spark, sf):
    variant = R.choose_variant(F.col("file_name"), (("log", ("blog", "news")), ("order", ("shop",))))
    return page_files(spark, sf).groupBy(variant.alias("variant")).agg(F.count("*").alias("files"))
