import datetime

import pytest

from film import PEOPLE, SCHEMA, TREK, results
from loomgraph.operators import algorithms, filters, layouts, views
from loomgraph.plans.catalog import ReservedFilter
from loomgraph.sources.results import graph_of_results


@pytest.fixture(scope="module")
def graph(spark):
    return graph_of_results(spark.createDataFrame([(results(),)], "value string"), SCHEMA)


#: Fixed values below: the published counts and ranks of the sample data.
def test_layout_sizes(graph):
    assert layouts.typed_triples(graph).count() == 61
    assert layouts.string_triples(graph).count() == 61
    assert layouts.typed_nodes(graph).count() == 49
    assert layouts.edges(graph).count() == 12
    assert layouts.wide_nodes(graph).count() == 10


def test_one_value_column_is_set(graph):
    for row in layouts.typed_triples(graph).collect():
        values = [c for c in row.__fields__ if c.startswith("object") and c != "objectType" and row[c] is not None]
        assert len(values) == 1


def test_string_values(graph):
    found = {(r.predicate, r.objectString, r.objectType) for r in layouts.string_triples(graph).where("subject = 8").collect()}
    assert ("revenue", "5.34E8", "double") in found
    assert ("release_date", "1980-05-21 00:00:00.0", "timestamp") in found
    assert ("running_time", "124", "long") in found
    assert ("director", "5", "uid") in found


def test_languages(graph):
    titles = layouts.typed_triples(graph).where(filters.language_of("title"))
    assert titles.where("predicate = 'title'").count() == 3
    assert titles.where("predicate <> 'title'").count() == 18
    assert titles.where("predicate = 'title@de'").count() == 3
    assert layouts.typed_triples(graph).where("predicate like 'age%'").count() == 0


def test_wide_nodes(graph):
    wide = {r.subject: r for r in layouts.wide_nodes(graph).collect()}
    assert wide[TREK]["title"] is None and wide[TREK]["running_time"] == 132
    assert wide[7]["release_date"] == datetime.datetime(1977, 5, 25) and wide[8]["release_date"] == datetime.datetime(1980, 5, 21)
    assert wide[1]["name"] == PEOPLE[1] and wide[1]["revenue"] is None
    names = layouts.wide_nodes(graph).columns
    assert names[0] == "subject" and names[1:] == sorted(names[1:])


def test_wide_and_long_agree(graph):
    from_wide = layouts.unpivoted(graph, layouts.wide_nodes(graph))
    long = layouts.typed_nodes(graph).where("predicate not like '%@%'")
    assert from_wide.exceptAll(long).isEmpty() and long.exceptAll(from_wide).isEmpty()


def test_subjects_signed_or_unsigned(graph):
    assert layouts.typed_triples(graph.subjects([0xA7EB7890D6DB0F1F])).count() == layouts.typed_triples(graph.subjects([TREK])).count() == 5
    assert layouts.typed_triples(graph).where(filters.subject_in(TREK, 1)).count() == 7


def test_reserved(graph):
    assert layouts.typed_triples(graph.reserved(ReservedFilter(None, "graph.*"))).count() == 51


def test_pagerank(spark, graph):
    vertices, links = views.frame_vertices(graph).select("id"), views.frame_edges(graph)
    for ranks in (algorithms.pagerank(vertices, links, 10), algorithms.pagerank(vertices, links, tolerance=0.0001)):
        found = {r.id: r.pagerank for r in ranks.collect()}
        for uid in (7, 8, 9, TREK):
            assert found[uid] == pytest.approx(0.7968128, abs=1e-6)
        for uid in (1, 2, 3):
            assert found[uid] == pytest.approx(1.3047808, abs=1e-6)
        for uid in (4, 5, 6):
            assert found[uid] == pytest.approx(0.96613544, abs=1e-6)


def test_no_triangles(graph):
    counted = algorithms.triangle_count(views.frame_vertices(graph).select("id"), views.frame_edges(graph)).collect()
    assert len(counted) == 10 and {r.triangles for r in counted} == {0}


def test_triplets(graph):
    rows = views.triplets(views.frame_vertices(graph), views.frame_edges(graph)).collect()
    assert len(rows) == 12
    assert {r.dst["name"] for r in rows if r.edge["predicate"] == "starring"} == {PEOPLE[1], PEOPLE[2], PEOPLE[3]}


def test_frame_names(graph):
    assert "release__date" in views.frame_vertices(graph).columns and "graph_type" in views.frame_vertices(graph).columns
    assert views.property_vertices(graph).count() == 49 and views.property_edges(graph).count() == 12


def test_degrees(graph):
    found = {r.id: (r.out_degree, r.in_degree) for r in algorithms.degrees(views.frame_edges(graph)).collect()}
    assert found[7] == (4, 0) and found[1] == (0, 3) and found[4] == (0, 1) and TREK not in found


def test_node_maps(graph):
    found = {r.subject: r.properties for r in layouts.node_maps(graph).collect()}
    assert found[1] == {"graph.type": "Person", "name": PEOPLE[1]}


def test_empty_graph(spark):
    empty = graph_of_results(spark.createDataFrame([('{"result": []}',), (None,)], "value string"), SCHEMA)
    for layout in (layouts.typed_triples, layouts.string_triples, layouts.typed_nodes, layouts.edges, layouts.wide_nodes):
        assert layout(empty).count() == 0
