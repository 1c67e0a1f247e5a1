"""A graph from query results in JSON: ``{"result": [{"uid": "0x1", "name": …, "friend": [{"uid": "0x2"}]}]}``.

Each node is an object with its id as hex; list values are a value each; a key
``name@en`` belongs to predicate ``name`` if that has languages and is dropped otherwise.
What a value is, its JSON type says: a text that looks like a list stays a text.
A list within a list, and an object that is no node, is its JSON text.  A report
that is no JSON, or null, has no nodes; a node without a known id is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.storage import stored
from loomgraph.functions.types import KINDS, parse_timestamp, uid_from_hex
from loomgraph.plans.catalog import Schema
from loomgraph.sources.graph import Branch, Graph


def entries(results: DataFrame, column: str = "value") -> DataFrame:
    """``subject``, ``key``, ``value`` (text, or JSON text) and ``node`` (the id, if it is a node) of each value of each node."""
    parsed = F.try_parse_json(F.col(f"`{column}`"))
    nodes = results.select(F.explode(F.try_variant_get(parsed, "$.result", "array<map<string, variant>>")).alias("node"))
    uid = F.try_variant_get(F.col("node")["uid"], "$", "string")
    subject = F.when(uid.rlike("^0[xX][0-9a-fA-F]{1,16}$"), uid_from_hex(uid))
    one = nodes.select(subject.alias("subject"), F.explode("node").alias("key", "own")).filter("key <> 'uid' AND subject IS NOT NULL")
    many = F.when(F.schema_of_variant("own").startswith("ARRAY"), F.try_variant_get("own", "$", "array<variant>")).otherwise(F.array("own"))
    each = one.select("subject", "key", F.explode(many).alias("own")).filter(~F.is_variant_null("own"))
    node = F.when(F.schema_of_variant("own").startswith("OBJECT"), F.try_variant_get("own", "$.uid", "string"))
    return each.select("subject", "key", F.try_variant_get("own", "$", "string").alias("value"), node.alias("node"))


def _value(kind: str) -> Column:
    if kind == "uid":
        return uid_from_hex(F.col("node"))
    if kind == "datetime":
        return parse_timestamp(F.col("value"))
    return F.col("value").cast(KINDS[kind][2])


def graph_of_results(results: DataFrame, schema: Schema, column: str = "value") -> Graph:
    """The graph in a table of query results, which are decoded once, into a folder for each predicate and for its languages."""
    base, lang = F.substring_index("key", "@", 1), F.when(F.col("key").contains("@"), F.expr("substring(key, instr(key, '@') + 1)"))
    named = entries(results, column).select("subject", "value", "node", lang.alias("lang"), base.alias("predicate"))
    known = [F.col("predicate").isin([p.name for p in schema.predicates]), F.col("lang").isNull() | F.col("predicate").isin([p.name for p in schema.predicates if p.lang])]
    kept = named.filter(known[0] & known[1]).withColumn("tagged", F.col("lang").isNotNull())
    rows, _ = stored(kept.hint("rebalance", "predicate", "tagged"), "results", "predicate", "tagged")
    branches = []
    for p in schema.by_name.values():
        own = rows.filter((F.col("predicate") == p.name) & ~F.col("tagged"))
        if p.kind == "uid":
            own = own.filter("node IS NOT NULL")
        branches.append(Branch(p, own, F.col("subject"), _value(p.kind)))
        if p.lang:
            branches.append(Branch(p, rows.filter((F.col("predicate") == p.name) & F.col("tagged")), F.col("subject"), _value(p.kind), F.col("lang")))
    return Graph(results.sparkSession, schema, tuple(branches))
