"""Connected components of a link table by repeated contraction.

A round points every vertex at its smallest neighbour, follows the pointers to
their ends, and replaces the links by links between the ends.  Vertices that
remain shrink by a constant factor or better in a round; the number of rounds
grows with the logarithm of the longest path.  All state lies in shared tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import discard, written


def _ends(pointers: DataFrame) -> tuple[DataFrame, str]:
    """Follow v -> to until every ``to`` points at itself; roots are not listed."""
    spark = pointers.sparkSession
    table, path = written(pointers, "pointers")
    while True:
        onward = table.select(F.col("v").alias("to"), F.col("to").alias("further"))
        jumped, next_path = written(
            table.join(onward, "to", "left").select("v", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")),
            "pointers",
        )
        moved = not jumped.filter("moved").isEmpty()
        discard(spark, path)
        table, path = jumped.select("v", "to"), next_path
        if not moved:
            return table, path


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a, b of one orderable type.  Returns (v, root) for every vertex that has
    a link to another one, ``root`` being the smallest vertex of its component."""
    spark = links.sparkSession
    edges, path = written(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    found, found_path = None, None
    while not edges.isEmpty():
        both = edges.select(F.col("b").alias("v"), F.col("a").alias("n")).unionAll(edges.select(F.col("a").alias("v"), F.col("b").alias("n")))
        smallest = both.groupBy("v").agg(F.min("n").alias("to")).filter("to < v")
        ends, ends_path = _ends(smallest)
        left = ends.select(F.col("v").alias("a"), F.col("to").alias("ra"))
        right = ends.select(F.col("v").alias("b"), F.col("to").alias("rb"))
        moved = (
            edges.join(left, "a", "left")
            .join(right, "b", "left")
            .select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges, next_path = written(moved, "links")
        if found is None:
            found, next_found = ends, ends_path
        else:
            step = ends.select(F.col("v").alias("to"), F.col("to").alias("further"))
            merged = found.join(step, "to", "left").select("v", F.coalesce("further", "to").alias("to")).unionAll(
                ends.join(found.select("v"), "v", "left_anti")
            )
            found, next_found = written(merged, "found")
            discard(spark, ends_path, found_path)
        discard(spark, path)
        path, found_path = next_path, next_found
    if found is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    discard(spark, path)
    found = found.select("v", F.col("to").alias("root"))
    roots = found.select(F.col("root").alias("v"), "root").distinct()
    return found.unionAll(roots)
