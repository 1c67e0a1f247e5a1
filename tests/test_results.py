import json

import pytest

from loomgraph.functions.types import Predicate
from loomgraph.operators import layouts
from loomgraph.plans import partitioner, protocols
from loomgraph.plans.catalog import Schema
from loomgraph.plans.density import binary_middle, log_middle
from loomgraph.sources.remote import Executor, ResultTooLarge, answered, run_queries
from loomgraph.sources.results import entries, graph_of_results

NODE = {
    "uid": "0x1", "name": "[draft] title", "quoted": '["a"]', "brace": '{"a": 1}', "list": ["a", ["b", "c"], None, "[x]", {"k": [1]}], "none": None, "number": 5, "text": "null",
    "yes": True, "friend": [{"uid": "0x2"}, {"uid": "0xa7eb7890d6db0f1f"}], "one": {"uid": "0x9"}, "empty": [], "name@en": "[en]", "number@en": "dropped", "blank": "",
}
SCHEMA = Schema.of(
    [Predicate(n, "string", n == "name") for n in ("name", "quoted", "brace", "list", "none", "text", "empty", "blank")]
    + [Predicate("number", "int"), Predicate("yes", "bool"), Predicate("friend", "uid"), Predicate("one", "uid")]
)


@pytest.fixture(scope="module")
def reports(spark):
    other = {"result": [{"name": "nobody"}, {"uid": "zz", "name": "bad"}, {"uid": "0x3", "name": "three"}]}
    return spark.createDataFrame([(json.dumps({"result": [NODE]}),), ("no JSON",), (None,), ('{"result": 5}',), ('{"other": []}',), (json.dumps(other),)], "value string")


def test_values_by_json_type(reports):
    found = {}
    for r in entries(reports).where("subject = 1").collect():
        found.setdefault(r.key, []).append(r.value)
    assert found["name"] == ["[draft] title"] and found["quoted"] == ['["a"]'] and found["brace"] == ['{"a": 1}'] and found["text"] == ["null"] and found["blank"] == [""]
    assert found["list"] == ["a", '["b","c"]', "[x]", '{"k":[1]}'] and "none" not in found and "empty" not in found
    assert {r.subject for r in entries(reports).collect()} == {1, 3}


def test_graph(spark, reports):
    graph = graph_of_results(reports, SCHEMA)
    edges = {(r.subject, r.predicate, r.objectUid) for r in layouts.edges(graph).collect()}
    assert edges == {(1, "friend", 2), (1, "friend", 0xA7EB7890D6DB0F1F - (1 << 64)), (1, "one", 9)}
    strings = {(r.predicate, r.objectString) for r in layouts.string_triples(graph).where("subject = 1 AND objectType <> 'uid'").collect()}
    assert {("name", "[draft] title"), ("name@en", "[en]"), ("number", "5"), ("yes", "true"), ("list", "[x]")} <= strings
    assert not any(p == "number@en" for p, _ in strings)
    wide = {r.subject: r for r in layouts.wide_nodes(graph).collect()}
    assert wide[1].number == 5 and wide[1].yes is True and wide[3]["name"] == "three" and wide[3].list is None


def test_one_decoding(spark, reports):
    plan = layouts.typed_triples(graph_of_results(reports, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan
    only = layouts.typed_triples(graph_of_results(reports, SCHEMA).only(["number"]))._jdf.queryExecution().executedPlan().toString()
    assert only.count("FileScan") == 1 and "predicate#" in only.split("PartitionFilters")[1]


def store():
    """An executor, whose class travels to the workers by value."""

    class Store:
        def query(self, text: str) -> str:
            if text == "large":
                raise RuntimeError("RESOURCE_EXHAUSTED: message larger than max")
            return json.dumps({"result": [{"uid": text, "name": f"node {text}"}]})

    return Store


def test_remote_queries(spark):
    queries = spark.createDataFrame([("0x5",), ("0x6",), (None,)], "query string")
    graph = graph_of_results(run_queries(queries, store()), Schema.of([Predicate("name", "string")]))
    assert {(r.subject, r.objectString) for r in layouts.string_triples(graph).collect()} == {(5, "node 0x5"), (6, "node 0x6")}
    with pytest.raises(ResultTooLarge, match="chunkSize"):
        answered(store()(), "large")


def test_protocols():
    assert isinstance(store()(), Executor) and not isinstance(object(), Executor)
    assert all(isinstance(x, protocols.Middle) for x in (log_middle, binary_middle))
    assert all(isinstance(x, protocols.Partitioner) for x in (partitioner.singleton, partitioner.group, partitioner.alpha, partitioner.predicate))
    assert isinstance(layouts.typed_triples, protocols.Layout)
