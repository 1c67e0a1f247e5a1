"""Pages of node ids, the gaps between ids, and where ids are dense."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.storage import stored
from loomgraph.plans.density import Probe


def page(rows: DataFrame, after: int, size: int, until: int | None = None) -> DataFrame:
    """The rows of the first ``size`` subjects beyond ``after`` and below ``until``."""
    if size <= 0:
        raise ValueError(f"Chunk length must be larger than zero: {size}")
    beyond = rows.filter(F.col("subject") > after)
    if until is not None:
        beyond = beyond.filter(F.col("subject") < until)
    some = beyond.select("subject").distinct().orderBy("subject").limit(size)
    return beyond.join(some, "subject", "left_semi")


def ranged(rows: DataFrame, key: str, parts: int | None = None) -> tuple[DataFrame, str]:
    """Distinct rows, stored in the order of ``key``, which tells them apart: ``range`` and ``nth``, the place in it, from 0.

    Ranges are sorted side by side.  They are stored, because the bounds of ranges come from a sample: two plans of the
    same rows need not cut them alike.
    """
    dealt = rows.repartitionByRange(parts, key) if parts else rows.repartitionByRange(key)
    at = F.monotonically_increasing_id()  # the partition's number, then the row's in it
    ordered = dealt.distinct().sortWithinPartitions(key)
    return stored(ordered.select("*", F.shiftrightunsigned(at, 33).cast("int").alias("range"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")), "ranged")


def _totals(table: DataFrame, weight: Column) -> DataFrame:
    """A row a range: ``range`` and ``base``, the weight of all ranges before."""
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    each = table.groupBy("range").agg(F.sum(weight).alias("total"))
    return each.select("range", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def placed(table: DataFrame) -> DataFrame:
    """A stored table of ranges with ``place``, the number of each row in the whole order, from 0."""
    return table.join(F.broadcast(_totals(table, F.lit(1))), "range").withColumn("place", F.col("base") + F.col("nth")).drop("base")


def _beside(table: DataFrame, step: int, **columns: str) -> DataFrame:
    """With columns of the row before (step -1) or after (1) in the whole order; at a range's edge they come from the next range."""
    move = F.lag if step < 0 else F.lead
    order = Window.orderBy("range")
    pick = F.max_by if step < 0 else F.min_by
    edges = table.groupBy("range").agg(*[pick(c, "nth").alias(f"edge_{n}") for n, c in columns.items()])
    edges = edges.select("range", *[move(f"edge_{n}").over(order).alias(f"edge_{n}") for n in columns])  # a row a range
    own = Window.partitionBy("range").orderBy("nth")
    shifted = table.select("*", *[move(c).over(own).alias(f"own_{n}") for n, c in columns.items()]).join(F.broadcast(edges), "range")
    beside = shifted.select("*", *[F.coalesce(f"own_{n}", f"edge_{n}").alias(n) for n in columns])
    return beside.drop(*[f"{kind}_{n}" for n in columns for kind in ("own", "edge")])


def chunk_ids(subjects: DataFrame, size: int, parts: int | None = None) -> DataFrame:
    """``subject`` and ``chunk``: the number of the page of ``size`` subjects that it is on."""
    table, _ = ranged(subjects.select("subject"), "subject", parts)
    return placed(table).select("subject", F.expr(f"place div {size}").alias("chunk"))


def gaps(subjects: DataFrame, parts: int | None = None) -> DataFrame:
    """``subject`` and ``gap`` to the subject before; the first has none."""
    table, _ = ranged(subjects.select("subject"), "subject", parts)
    return _beside(table, -1, before="subject").filter("before IS NOT NULL").select("subject", (F.col("subject") - F.col("before")).alias("gap"))


def upper_median_gap(subjects: DataFrame, parts: int | None = None) -> DataFrame:
    """The upper median of the gaps, as ``median``; null if there are none."""
    table, _ = ranged(gaps(subjects, parts).groupBy("gap").agg(F.count(F.lit(1)).alias("n")), "gap", parts)
    half = table.agg(F.coalesce(F.expr("sum(n) div 2"), F.lit(0)).alias("half"))
    own = Window.partitionBy("range").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    upto = table.withColumn("own", F.sum("n").over(own)).join(F.broadcast(_totals(table, F.col("n"))), "range")
    return upto.join(F.broadcast(half), F.col("base") + F.col("own") > F.col("half")).agg(F.min("gap").alias("median"))


def dense_runs(subjects: DataFrame, threshold: int, repeats: int = 1, parts: int | None = None) -> DataFrame:
    """Runs of subjects whose gaps are below ``threshold``, of at least ``repeats`` gaps: ``first``, ``last``, ``subjects``."""
    table, _ = ranged(subjects.select("subject"), "subject", parts)
    begins = _beside(placed(table), -1, before="subject").filter(f"before IS NULL OR subject - before >= {threshold}")
    # a run ends before the next one begins, and the last run with the last subject
    starts, _ = ranged(begins.select("subject", "place", "before"), "subject", parts)
    whole = table.agg(F.max("subject").alias("highest"), F.count(F.lit(1)).alias("total"))
    runs = _beside(starts, 1, last="before", end="place").join(F.broadcast(whole)).select(
        F.col("subject").alias("first"), F.coalesce("last", "highest").alias("last"), (F.coalesce("end", "total") - F.col("place")).alias("subjects")
    )
    return runs.filter(F.col("subjects") > repeats)


def prober(subjects: DataFrame) -> Probe:
    """Probes a table of subjects for :func:`loomgraph.plans.density.dense_end`; a probe is a top-k query."""

    def probe(first: int, k: int) -> list[int]:
        return [r["subject"] for r in subjects.filter(F.col("subject") >= first).select("subject").distinct().orderBy("subject").limit(k).collect()]

    return probe


def id_histogram(subjects: DataFrame, width: int) -> DataFrame:
    """``bucket`` and ``n``: how many distinct subjects each run of ``width`` ids has."""
    return subjects.select("subject").distinct().groupBy(F.expr(f"subject div {width}").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
