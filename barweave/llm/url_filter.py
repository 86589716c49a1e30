"""URL filters: a sort-merge range join of pages with nested host and path rules.

A host is written with its labels reversed and a dot behind each (``www.example.com`` is
``com.example.www.``), so a rule's host and all its subdomains are one interval of keys,
and such intervals are nested or disjoint. Rules and the distinct hosts of the pages are
sorted together by that key; a sweep keeps the stack of rules that enclose the last rule
passed, and what of the stack has not ended yet encloses the host it has reached. The
stack hands the paths of its rules on, and of those the url's path begins with the longest
rule wins. (Host and path together are no interval: ``example.com/en/`` has to meet
``www.example.com/en/`` but not ``example.com/fr/``. So the host is swept, the path tested.)

Only distinct hosts are sorted, so a host that has a third of all pages is one row there.
The sweep runs in every range of keys at once: a range begins with the stack of the last
rule before it, and those are one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.common import Packed, ascii_lower
from barweave.session import materialize

RULE_COLUMNS = ("host", "path", "verdict")


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit("."))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path``, ``verdict``. A rule fits its host and all subdomains
    if the url's path starts with the rule's. The longest rule (host and path together)
    wins, then the one with the longer host, then ``block`` over ``allow``. Without a rule
    ``rule`` is null and ``verdict`` the default.

    A null url or one without ``://`` has an empty host and path and no rule. Rules with a
    null in them or an empty host are ignored, repeated rules count once; without rules or
    pages the result is as it should be. Repeated rows and null ids stay as they are.
    Columns of ``pages`` named like one of the four are replaced.
    """
    made = ("host", "path", "rule", "verdict")
    packed = Packed(pages)
    parsed = packed.rows.select(
        "*", url_host(packed[url]).alias("host"), url_path(packed[url]).alias("path")
    )
    stacks = sweep(parsed.select("host").distinct(), _levels(rules))
    fits = F.filter("_rules", lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        parsed.join(stacks, "host")
        .withColumn("_best", F.array_max(fits))
        .select(
            *packed.back(made),
            "host",
            "path",
            F.col("_best.rule").alias("rule"),
            F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def _levels(rules: DataFrame) -> DataFrame:
    """One row per ruled host: its interval, its rules, and the stack that encloses it."""
    known = rules.select(*RULE_COLUMNS).dropna().where("host <> ''").distinct()
    rule = F.concat("host", "path")
    levels = known.groupBy(host_key(F.col("host")).alias("lo")).agg(
        F.collect_list(
            F.struct(
                F.length(rule).alias("size"),
                F.length("host").alias("host_size"),
                "verdict",
                rule.alias("rule"),
                "path",
            )
        ).alias("rules")
    )
    # The key ends in a dot; the next character ends the interval of its prefixes.
    levels = levels.select("lo", F.expr("left(lo, length(lo) - 1) || '/'").alias("hi"), "rules")
    labels = F.split("lo", "\\.", -1)
    enclosing = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )
    return (
        levels.select(F.col("lo").alias("key"), F.explode(enclosing).alias("lo"))
        .join(levels, "lo")
        .groupBy("key")
        .agg(F.collect_list(F.struct("lo", "hi", "rules")).alias("stack"))
    )


def sweep(hosts: DataFrame, levels: DataFrame) -> DataFrame:
    """``host`` and the ``_rules`` of all intervals that hold it."""
    nothing = F.lit(None).cast("string")
    events = levels.select("key", F.lit(0).alias("kind"), nothing.alias("host"), "stack").unionByName(
        hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host"),
        allowMissingColumns=True,
    )
    # Written once: the ranges must be the same for the sweep and for what it begins with.
    placed = materialize(
        events.repartitionByRange("key", "kind").withColumn("part", F.spark_partition_id())
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        placed.groupBy("part")
        .agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("_last"))
        .select("part", F.last("_last", ignorenulls=True).over(earlier).alias("_begin"))
    )
    passed = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    swept = placed.withColumn("_stack", F.last("stack", ignorenulls=True).over(passed))
    open_at = (
        swept.where("kind = 1")
        .join(F.broadcast(begins), "part")  # one row per range
        .withColumn("_stack", F.coalesce("_stack", "_begin"))
    )
    active = F.filter("_stack", lambda level: level["hi"] > F.col("key"))
    return open_at.select(
        "host", F.flatten(F.transform(active, lambda level: level["rules"])).alias("_rules")
    )
