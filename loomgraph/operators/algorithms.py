"""Degrees, PageRank and triangles over tables of vertices (``id``) and edges (``src``, ``dst``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.storage import discard, stored

#: Rounds after which an iteration's state is stored, which keeps plans short.
CUT = 5
#: Edges of a vertex that lie in one place.
HUB = 100_000


def degrees(links: DataFrame) -> DataFrame:
    """``id``, ``out_degree`` and ``in_degree`` of every vertex with an edge."""
    both = links.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(
        links.select(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    )
    return both.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def pagerank(vertices: DataFrame, links: DataFrame, rounds: int | None = 10, tolerance: float | None = None, reset: float = 0.15, most_rounds: int = 200) -> DataFrame:
    """``id`` and ``pagerank``, whose mean is one.

    Every vertex starts with 1; a round gives it ``reset`` plus the rest of its neighbours' ranks, each shared
    among that neighbour's edges.  Runs ``rounds`` rounds, or until no rank moves by more than ``tolerance``.
    """
    spark = links.sparkSession
    # edges stay where their source's rank will be needed, so that a round moves ranks only; a hub's lie in several places
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    outs = links.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    table, shares_path = stored(
        links.join(outs, "src").groupBy("src", "dst").agg((F.count(F.lit(1)) / F.first("out")).alias("share"), F.expr(f"int(first(out) div {HUB})").alias("salts")),
        "shares",
    )
    hubs, hubs_path = stored(table.filter("salts > 0").select("src", "salts").distinct(), "hubs")
    flat = hubs.isEmpty()
    salted = table.withColumn("salt", F.when(F.col("salts") > 0, F.pmod(F.xxhash64("dst"), F.col("salts") + 1)).otherwise(0).cast("int")).drop("salts")
    shares = (table.drop("salts").repartition(partitions, "src") if flat else salted.repartition(partitions, "src", "salt")).persist()

    def sent(ranks: DataFrame) -> DataFrame:
        """Ranks as their sources' edges need them: a hub's to each of the places of its edges."""
        own = ranks.withColumnRenamed("id", "src")
        if flat:
            return shares.join(own, "src")
        copies = own.join(hubs, "src", "left").select("src", "rank", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(0)))).alias("salt"))
        return shares.join(copies, ["src", "salt"])

    ids, ids_path = stored(vertices.select("id").distinct(), "ids")
    ranks, paths = ids.withColumn("rank", F.lit(1.0)), []
    for i in range(1, (rounds if tolerance is None else most_rounds) + 1):
        moved = sent(ranks).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("given"))
        after = ids.join(moved, "id", "left").select("id", (F.lit(reset) + (1 - reset) * F.coalesce("given", F.lit(0.0))).alias("rank"))
        done = False
        if i % CUT == 0 or tolerance is not None:
            before, (after, path) = ranks, stored(after, "ranks")
            if tolerance is not None:
                far = before.join(after.withColumnRenamed("rank", "now"), "id").filter(F.abs(F.col("now") - F.col("rank")) > tolerance)
                done = far.isEmpty()
            discard(spark, *paths)
            paths = [path]
        ranks = after
        if done:
            break
    total = ranks.agg((F.count(F.lit(1)) / F.sum("rank")).alias("scale")).first()["scale"]
    out, _ = stored(ranks.select("id", (F.col("rank") * F.lit(total or 1.0)).alias("pagerank")), "pagerank")
    shares.unpersist()
    discard(spark, shares_path, hubs_path, ids_path, *paths)
    return out


def triangle_count(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """``id`` and ``triangles`` of every vertex; edges count without direction, loops and repeats not at all.

    Each edge points from the end of fewer edges to the other, so that no vertex, however many edges it has,
    has many going out: the pairs that are joined stay near the number of edges times its square root.
    """
    plain, path = stored(
        links.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct(), "plain"
    )
    degree = plain.select(F.col("a").alias("v")).unionAll(plain.select(F.col("b").alias("v"))).groupBy("v").agg(F.count(F.lit(1)).alias("d"))
    ranked = plain.join(degree.select(F.col("v").alias("a"), F.col("d").alias("da")), "a").join(degree.select(F.col("v").alias("b"), F.col("d").alias("db")), "b")
    up = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    aimed, aimed_path = stored(
        ranked.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("s"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("t")), "aimed"
    )
    other = aimed.select("s", F.col("t").alias("u"))
    wedges = aimed.join(other, "s").filter("t < u")
    closed = wedges.join(plain.select(F.col("a").alias("t"), F.col("b").alias("u")), ["t", "u"])
    corners = closed.select(F.explode(F.array("s", "t", "u")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    counted, _ = stored(vertices.select("id").distinct().join(corners, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("triangles")), "triangles")
    discard(links.sparkSession, path, aimed_path)
    return counted
