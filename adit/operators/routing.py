"""Which jobs read a file. Rules are a short fixed list, so they compile into one expression per file:
no join, no shuffle, and fan-out is a single explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adit.functions import text as tx


def glob_regex(pattern: str) -> str:
    """A shell pattern as an anchored regex."""
    wild = {"*": ".*", "?": "."}
    return "".join(wild.get(ch) or tx._literal(ch) for ch in pattern.lower())


def rule_targets(name: Column, rules) -> Column:
    """array<struct(target, priority)> of all rules with a matching pattern."""
    folded = F.lower(name)
    hits = [
        F.when(
            folded.rlike("(?s)^(?:" + "|".join(glob_regex(p) for p in patterns) + ")$"),
            F.struct(F.lit(target).alias("target"), F.lit(priority).alias("priority")),
        )
        for patterns, target, priority in rules
    ]
    return F.array_compact(F.array(*hits))


def keyword_targets(name: Column, keywords) -> Column:
    """The same for (target, words) pairs; such hits have priority 0."""
    folded = F.lower(name)
    hits = []
    for target, words in keywords:
        any_word = F.lit(False)
        for word in words:
            any_word = any_word | folded.contains(word)
        hits.append(F.when(any_word, F.struct(F.lit(target).alias("target"), F.lit(0).alias("priority"))))
    return F.array_compact(F.array(*hits))


def _fan_out(files: DataFrame, targets: Column) -> DataFrame:
    # The names are matched once per file, before the rows multiply; the inner form would match them twice.
    routed = files.withColumn("_route", targets)
    return routed.select(*files.columns, F.inline_outer("_route")).where("target is not null")


def route_files(files: DataFrame, rules, name: str = "file_name") -> DataFrame:
    """One row per file and matching rule; files matching none disappear."""
    return _fan_out(files, rule_targets(F.col(name), rules))


def registered_only(rules, registered) -> list:
    """Rules whose target has a job."""
    return [rule for rule in rules if rule[1] in registered]


def route_with_fallback(files: DataFrame, rules, keywords, default: str, name: str = "file_name") -> DataFrame:
    """Rules first; a file with none goes by key words; a file with neither goes to the default job."""
    by_rule, by_word = rule_targets(F.col(name), rules), keyword_targets(F.col(name), keywords)
    fallback = F.array(F.struct(F.lit(default).alias("target"), F.lit(-1).alias("priority")))
    matched = files.withColumn("_rules", by_rule)
    targets = (
        F.when(F.size("_rules") > 0, F.col("_rules"))
        .when(F.size(by_word) > 0, by_word)
        .otherwise(fallback)
    )
    return matched.select(*files.columns, F.inline_outer(targets))


def choose_variant(name: Column, variants, default: str = "generic") -> Column:
    """The first (variant, words) pair with a word in the lower-cased file name."""
    folded, chain = F.lower(name), None
    for variant, words in variants:
        hit = F.lit(False)
        for word in words:
            hit = hit | folded.contains(word)
        chain = F.when(hit, variant) if chain is None else chain.when(hit, variant)
    return chain.otherwise(default)
