"""F-keys: scalar expressions over the driver's texts, dates and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.functions import classify as C
from adit.functions import dates as D
from adit.functions import numbers as N
from adit.functions import text as T
from suite.base import load, load_spread, query, sql_round

SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_clean(expr: str) -> str:
    return rf"coalesce(trim(regexp_replace({expr}, '{SPACE}+', ' ', 'g'), ' '), '')"


@query("clean_text", f"SELECT doc_id, md5({sql_clean('text')}) AS h, length({sql_clean('text')}) AS n FROM documents")
def clean_text(spark, sf):
    clean = T.clean_whitespace(F.col("text"))
    return load_spread(spark, sf, "documents").select("doc_id", F.md5(clean).alias("h"), F.length(clean).cast("bigint").alias("n"))


_special = sql_clean(rf"regexp_replace(text, '[^а-яА-Яa-zA-Z0-9\.\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]', '', 'g')")
_letters = sql_clean(r"regexp_replace(text, '[^а-яА-Яa-zA-Z\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', '', 'g')")


@query("strip_special", f"SELECT doc_id, md5({_special}) AS kept, md5({_letters}) AS letters FROM documents")
def strip_special(spark, sf):
    text = F.col("text")
    return load_spread(spark, sf, "documents").select(
        "doc_id",
        F.md5(T.strip_special(text)).alias("kept"),
        F.md5(T.strip_special(text, keep_dots=False, keep_digits=False)).alias("letters"),
    )


@query("fold_case", "SELECT doc_id, md5(coalesce(replace(lower(text), 'ё', 'е'), '')) AS h FROM documents")
def fold_case(spark, sf):
    return load_spread(spark, sf, "documents").select("doc_id", F.md5(T.fold_case(F.col("text"))).alias("h"))


@query(
    "extract_numbers",
    r"""SELECT doc_id, len(regexp_extract_all(text, '\d+[.,]\d+|\d+')) AS n,
        CAST(replace(nullif(regexp_extract(text, '\d+[.,]\d+|\d+'), ''), ',', '.') AS DOUBLE) AS first_number,
        array_to_string(list_transform(regexp_extract_all(text, '\d+'), lambda x: coalesce(CAST(try_cast(x AS BIGINT) AS VARCHAR), '?')), ' ') AS whole
        FROM documents""",
)
def extract_numbers(spark, sf):
    text = F.col("text")
    return load_spread(spark, sf, "documents").select(
        "doc_id",
        F.size(N.extract_numbers(text)).cast("bigint").alias("n"),
        N.first_number(text).alias("first_number"),
        F.array_join(
            F.transform(N.extract_numbers(text, as_float=False), lambda x: F.coalesce(x.cast("string"), F.lit("?"))), " "
        ).alias("whole"),
    )


_brackets = sql_clean(r"regexp_replace(regexp_replace(text, '\([^)]*\)', '', 'g'), '\[[^\]]*\]', '', 'g')")


@query("drop_brackets", f"SELECT doc_id, md5({_brackets}) AS h, length({_brackets}) AS n FROM documents")
def drop_brackets(spark, sf):
    bare = T.drop_brackets(F.col("text"))
    return load_spread(spark, sf, "documents").select("doc_id", F.md5(bare).alias("h"), F.length(bare).cast("bigint").alias("n"))


@query(
    "split_name",
    """WITH n AS (SELECT c_custkey AS id, c_name AS name FROM customer
                 UNION ALL SELECT -1 - p_partkey, p_name || ' ' || p_type FROM part),
            w AS (SELECT id, string_split(trim(regexp_replace(name, '\\s+', ' ', 'g')), ' ') AS w FROM n)
       SELECT id, w[1] AS lastname, w[2] AS firstname, nullif(array_to_string(w[3:], ' '), '') AS middlename FROM w""",
)
def split_name(spark, sf):
    names = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    parts = load(spark, sf, "part").select((-1 - F.col("p_partkey")).alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    return names.unionAll(parts).select("id", F.inline(F.array(T.split_name(F.col("name")))))


@query(
    "split_table_line",
    r"""WITH l AS (SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN '| ' || s_name || ' |  | ' || s_nationkey || ' |'
                    WHEN 1 THEN s_name || ' | | ' || s_nationkey ELSE '|| ' || s_name || ' | ' || s_nationkey || ' || |' END AS line FROM supplier)
        SELECT id, array_to_string(string_split(regexp_replace(regexp_replace(line, '^[\s|]+|[\s|]+$', '', 'g'), '\s*\|\s*', '|', 'g'), '|'), '~') AS cells,
               len(string_split(regexp_replace(regexp_replace(line, '^[\s|]+|[\s|]+$', '', 'g'), '\s*\|\s*', '|', 'g'), '|')) AS n FROM l""",
)
def split_table_line(spark, sf):
    key = F.col("s_suppkey")
    name, nation = F.col("s_name"), F.col("s_nationkey").cast("string")
    line = (
        F.when(key % 3 == 0, F.concat(F.lit("| "), name, F.lit(" |  | "), nation, F.lit(" |")))
        .when(key % 3 == 1, F.concat(name, F.lit(" | | "), nation))
        .otherwise(F.concat(F.lit("|| "), name, F.lit(" | "), nation, F.lit(" || |")))
    )
    cells = T.split_table_line(line)
    return load(spark, sf, "supplier").select(
        key.alias("id"), F.array_join(cells, "~").alias("cells"), F.size(cells).cast("bigint").alias("n")
    )


@query(
    "to_float",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE l_extendedprice END AS v FROM lineitem""",
)
def to_float(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    written = (
        F.when(F.col("l_linenumber") % 4 == 0, F.translate(price, ".", ","))
        .when(F.col("l_linenumber") % 4 == 1, price)
        .when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit("  "), price, F.lit(" ")))
        .otherwise(F.when(F.col("l_orderkey") % 2 == 0, "-").otherwise(""))
    )
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.to_float(written).alias("v"))


@query(
    "to_int",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS INT) ELSE -CAST(o_custkey AS INT) END END AS v
       FROM orders""",
)
def to_int(spark, sf):
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    written = (
        F.when(key % 3 == 0, F.concat(cust, F.lit(" чел.")))
        .when(key % 3 == 1, F.concat(F.lit("от -"), cust, F.lit(" м")))
        .otherwise("чел.")
    )
    return load_spread(spark, sf, "orders").select("o_orderkey", N.to_int(written).alias("v"))


def written_date(stamp, kind):
    """A date in one of five written forms; kind 4 is not a date."""
    return (
        F.when(kind == 0, F.date_format(stamp, "dd.MM.yyyy"))
        .when(kind == 1, D.format_date_text(stamp))
        .when(kind == 2, F.date_format(stamp, "yyyy-MM-dd"))
        .when(kind == 3, F.date_format(stamp, "d/M/yyyy"))
        .otherwise("31.02.2023")
    )


@query(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso,
         CASE WHEN o_orderkey % 5 = 4 THEN 0 ELSE 1 END AS is_date, strftime(o_orderdate, '%Y-%m-%d') AS short_year
       FROM orders""",
)
def parse_date(spark, sf):
    written = written_date(F.col("o_orderdate"), F.col("o_orderkey") % 5)
    return load_spread(spark, sf, "orders").select(
        "o_orderkey",
        D.iso_date(written).alias("iso"),
        D.is_date(written).cast("int").alias("is_date"),
        D.iso_date(F.date_format("o_orderdate", "dd.MM.yy")).alias("short_year"),
    )


@query(
    "parse_timestamp",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN 2 THEN strftime(ts, '1900-01-01 %H:%M:%S') END AS stamp FROM events""",
)
def parse_timestamp(spark, sf):
    kind, ts = F.col("event_id") % 4, F.col("ts")
    written = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.date_format(ts, "HH:mm:ss"))
        .otherwise(F.date_format(ts, "dd.MM.yyyy HH:mm"))
    )
    return load_spread(spark, sf, "events").select("event_id", D.iso_timestamp(written).alias("stamp"))


@query(
    "extract_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders",
)
def extract_date(spark, sf):
    kind = F.col("o_orderkey") % 3
    inside = F.concat(F.lit("Заказ "), F.col("o_orderpriority"), F.lit(" от "), written_date(F.col("o_orderdate"), kind), F.lit(" года"))
    return load_spread(spark, sf, "orders").select("o_orderkey", F.date_format(D.extract_date(inside), "yyyy-MM-dd").alias("iso"))


@query(
    "format_date_text",
    """SELECT event_id, day(ts) || ' ' || ['января','февраля','марта','апреля','мая','июня','июля','августа','сентября','октября','ноября','декабря'][month(ts)]
         || ' ' || year(ts) || ' г.' AS day_text,
         day(ts) || ' ' || ['января','февраля','марта','апреля','мая','июня','июля','августа','сентября','октября','ноября','декабря'][month(ts)]
         || ' ' || year(ts) || ' г. ' || strftime(ts, '%H:%M:%S') AS full_text FROM events""",
)
def format_date_text(spark, sf):
    return load_spread(spark, sf, "events").select(
        "event_id",
        D.format_date_text(F.col("ts")).alias("day_text"),
        D.format_date_text(F.col("ts"), with_time=True).alias("full_text"),
    )


@query(
    "shift_class",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '1-я' WHEN 1 THEN '2-я' WHEN 2 THEN '3-я' WHEN 3 THEN '4-я' WHEN 4 THEN 'ночная' END AS shift FROM orders""",
)
def shift_class(spark, sf):
    kind = F.col("o_orderkey") % 6
    written = (
        F.when(kind == 0, "Первая").when(kind == 1, "2 смена").when(kind == 2, "3-я").when(kind == 3, "ЧЕТВЕРТАЯ").when(kind == 4, "ночная").otherwise("")
    )
    return load_spread(spark, sf, "orders").select("o_orderkey", C.shift_class(written).alias("shift"))


@query(
    "classify_text",
    """SELECT p_partkey, CASE WHEN contains(lower(p_type), 'steel') THEN 'ferrous' WHEN contains(lower(p_type), 'tin') THEN 'soft'
         WHEN contains(lower(p_type), 'copper') THEN 'soft' WHEN contains(lower(p_type), 'a') THEN 'light' ELSE 'other' END AS class FROM part""",
)
def classify_text(spark, sf):
    classes = (("STEEL", "ferrous"), ("tin", "soft"), ("copper", "soft"), ("a", "light"))
    return load(spark, sf, "part").select("p_partkey", C.classify(F.col("p_type"), classes, "other").alias("class"))


@query(
    "unit_lookup",
    """SELECT event_id, CASE event_type WHEN 'click' THEN '%' WHEN 'view' THEN '%' WHEN 'purchase' THEN 'm/s' WHEN 'error' THEN 'mmHg' END AS unit FROM events""",
)
def unit_lookup(spark, sf):
    kind = C.classify(F.col("event_type"), (("click", "CH4"), ("view", "CO"), ("purchase", "SPEED"), ("error", "PRESSURE")))
    return load_spread(spark, sf, "events").select("event_id", C.unit_of(kind).alias("unit"))


@query(
    "yes_no_flag",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE 1 END AS done,
         CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS spray FROM orders""",
)
def yes_no_flag(spark, sf):
    status = F.col("o_orderstatus")
    written = F.when(status == "F", "Да").when(status == "O", " не выполнено ").otherwise("?")
    return load_spread(spark, sf, "orders").select(
        "o_orderkey", C.yes_no(written, default=1).alias("done"), C.yes_no(written, default=0).alias("spray")
    )


@query(
    "quantity_units",
    f"""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN {sql_round('p_size / 10.0 * 1000000', 2)} WHEN 1 THEN CAST(p_size * 1000 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS tons,
         CAST((p_size + p_size + 31) // 2 AS DOUBLE) AS depth FROM part""",
)
def quantity_units(spark, sf):
    kind, size = F.col("p_partkey") % 3, F.col("p_size")
    written = (
        F.when(kind == 0, F.concat((size / 10).cast("string"), F.lit(" млн тонн/год")))
        .when(kind == 1, F.concat((size * 1000).cast("string"), F.lit(" т/год")))
        .otherwise(F.concat(size.cast("string"), F.lit(" т")))
    )
    depth = F.concat(size.cast("string"), F.lit("-"), (size + 31).cast("string"), F.lit(" м"))
    return load(spark, sf, "part").select(
        "p_partkey", F.round(N.production_tons(written), 2).alias("tons"), N.depth_m(depth).alias("depth")
    )


@query(
    "interval_split",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 3 THEN p_retailprice END AS low, CASE WHEN p_partkey % 4 <> 3 THEN CAST(p_size AS DOUBLE) END AS high FROM part",
)
def interval_split(spark, sf):
    written = F.when(
        F.col("p_partkey") % 4 != 3,
        F.concat_ws("-", F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.concat(F.col("p_size").cast("string"), F.lit(" "))),
    ).otherwise(F.concat(F.lit("1-2-"), F.col("p_size").cast("string")))
    bounds = N.interval_bounds(written)
    return load(spark, sf, "part").select("p_partkey", bounds["low"].alias("low"), bounds["high"].alias("high"))


@query(
    "grade_digit",
    "SELECT p_partkey, CAST(nullif(regexp_extract(p_brand, '[123]'), '') AS INT) AS grade FROM part",
)
def grade_digit(spark, sf):
    return load(spark, sf, "part").select("p_partkey", N.grade_digit(F.col("p_brand")).alias("grade"))


@query(
    "query_target",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'custom' ELSE lower(o_orderstatus) || '_log' END AS target FROM orders",
)
def query_target(spark, sf):
    from adit.tables.catalog import query_target as target

    table = F.concat(F.lower("o_orderstatus"), F.lit("_log"))
    sql = F.when(F.col("o_orderkey") % 4 == 3, "SHOW TABLES").otherwise(
        F.concat(F.lit("select a, b\nFROM  "), table, F.lit(" WHERE x = "), F.col("o_orderkey").cast("string"))
    )
    return load_spread(spark, sf, "orders").select("o_orderkey", target(sql).alias("target"))
