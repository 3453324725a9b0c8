"""Allow and block rules for urls, by a sorted sweep over nested intervals.

A rule is a host and the start of a path. Written as ``reversed host / path`` it is a
prefix, and all keys with that prefix form an interval. A url asks with one such key for
each of its host's suffixes that is no deeper than the deepest rule. Rule starts, rule
ends and urls are sorted together; intervals of prefixes nest, so the rules that are open
at a point form a stack. A start pushes its rule, an end pops back to the rule around it,
and a url reads the top.

Only DataFrame functions: one range shuffle sorts the events, a window within each range
keeps the top, and the top at the end of earlier ranges is carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import before, in_order, packed, unpacked

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
START, URL, END = 0, 1, 2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.encode(F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path), "UTF-8")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a DataFrame."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.range(0).select(
        *[F.lit("").alias(c) for c in ("verdict", "host", "path")]
    )


def _events(rules: DataFrame) -> DataFrame:
    """A push and a pop for each rule; ``top`` is the rule on the stack afterwards."""
    rule = F.struct(
        (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("of_host"),
        F.concat("host", "path").alias("rule"), "verdict",
    )
    own = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "verdict")
        # Of equal rules a blocking one counts: "block" is the greater word.
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(_key(F.split("host", r"\."), F.col("path")).alias("key"), "host", "path", rule.alias("own"))
    )
    # The rule around a rule has the same host and a shorter path that starts this one.
    shorter = own.where(F.length("path") > 0).select(
        "key", "host", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n"), "path"
    )
    outer = (
        shorter.select("key", "host", F.expr("substring(path, 1, n)").alias("path"))
        .join(own.select("host", "path", F.col("own").alias("outer")), ["host", "path"])
        .groupBy("key")
        .agg(F.max("outer").alias("outer"))
    )
    steps = F.array(
        F.struct(F.col("key").alias("key"), F.lit(START).alias("kind"), F.col("own").alias("top")),
        # 0xFF is in no UTF-8 text, so this lies behind every key with the prefix.
        F.struct(F.concat("key", F.lit(b"\xff")).alias("key"), F.lit(END).alias("kind"), F.col("outer").alias("top")),
    )
    return own.join(outer, "key", "left").select(F.inline(steps))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: list[str] | None = None, default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    The longest rule that fits wins (host and path together; then the longer host); where
    none fits, ``rule`` is null and ``verdict`` is ``default``. Urls that are null or have
    no ``://`` have an empty host and path and fit no rule with a host. Repeated rows and
    repeated rules are fine; rules with a null host or path are left out; an empty table
    gives an empty one. ``keep`` names the columns to carry, all by default; input columns
    with the names of added ones are replaced.
    """
    added = ["host", "path", "rule", "verdict"]
    kept = [name for name in (pages.columns if keep is None else keep) if name not in added]
    events = _events(rules)
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    url = F.col(url_col)
    named = pages.select(
        F.monotonically_increasing_id().alias("_row"), packed(kept).alias("_kept"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    labels = F.split("host", r"\.")
    suffix = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size(labels), F.lit(deepest))))).alias("_n")
    asks = named.select("*", suffix).select(
        "*", _key(F.slice(labels, -F.col("_n"), F.col("_n")), F.col("path")).alias("_key"), F.lit(URL).alias("_kind")
    )
    shape = [field for field in asks.schema if field.name not in ("_key", "_kind", "_n")]
    sweep = in_order(
        events.select(
            *[F.lit(None).cast(field.dataType).alias(field.name) for field in shape],
            F.col("key").alias("_key"), F.col("kind").alias("_kind"), F.struct(F.col("top").alias("rule")).alias("_top"),
        ).unionByName(
            asks.drop("_n").withColumn("_top", F.lit(None).cast(events.select(F.struct(F.col("top").alias("rule"))).schema[0].dataType))
        ),
        "_key", "_kind",
    )
    tops = sweep.groupBy("_part").agg(F.max_by("_top", F.when(F.col("_top").isNotNull(), F.col("_at"))).alias("_last"))
    carried = tops.select("_part", before(tops, F.last("_last", ignorenulls=True)).alias("_before"))
    here = F.last("_top", ignorenulls=True).over(
        Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    )
    # One row for each range, so the broadcast is as small as the list of tasks.
    fits = (
        sweep.withColumn("_here", here)
        .where(F.col("_kind") == URL)
        .join(F.broadcast(carried), "_part")
        .withColumn("_rule", F.coalesce("_here", "_before")["rule"])
    )
    return (
        fits.groupBy("_row")
        .agg(*[F.first(name).alias(name) for name in ("_kept", "host", "path")], F.max("_rule").alias("_rule"))
        .select(
            *unpacked(kept), "host", "path",
            F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", F.lit(default)).alias("verdict"),
        )
    )
