import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull

import __spark_entry__ as entry
from film import SCHEMA, TREK, results
from loomgraph.functions.storage import shared_folder
from loomgraph.functions.types import TYPED_TRIPLES, parse_timestamp, rotated_array, uid_from_hex, unsigned_order
from loomgraph.operators import algorithms, filters, layouts, paging, partitioned
from loomgraph.plans.partitioner import Part
from loomgraph.queries import ORACLE_SQL, QUERIES
from loomgraph.reader import install
from loomgraph.sources.results import graph_of_results
from loomgraph.sources.stored import _Reader, read_graph, register_formats, write_graph
from loomgraph.sources.tables import graph_of_tables, state_of_tables
from loomgraph.streaming.events import read_events, windowed

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: str(v).replace("T", " ") if hasattr(v, "isoformat") else float(v) if hasattr(v, "as_tuple") else v
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


CORE = [
    "triples_typed", "triples_string", "nodes_wide", "edges", "filter_subject_eq", "filter_subject_in", "filter_predicate_in", "filter_residual", "has_and_has",
    "lang_strings", "anti_reserved_nodes", "chunk_ids", "uid_gaps", "dense_runs", "sparsity_median", "part_predicate_uid_range", "part_alpha", "gf_vertices",
    "triplets", "pagerank", "pagerank_tolerance", "triangle_count", "event_windows", "reserved_include", "array_rotation", "json_triples", "json_wide",
    "cluster_state", "filter_any_value", "id_probe", "transaction_read", "format_edges", "format_triples", "parsed_dates",
]


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, sf, oracle, name):
    df = QUERIES[name](spark, sf)
    found = oracle.execute(ORACLE_SQL[name])
    expected = rows_of([d[0] for d in found.description], found.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark, sf):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLE_SQL) == set(QUERIES)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_predicate_filter_prunes_branches(spark, sf):
    graph = graph_of_tables(spark, sf)
    plan = scans_of(layouts.typed_triples(graph).where(filters.predicate_in("mktsegment")))
    assert plan.count("FileScan") == 2  # the property, and the languages of text, whose names are not constant
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
    assert "LocalTableScan <empty>" in scans_of(layouts.edges(graph).where(filters.predicate_in("order.part") & filters.predicate_in("nation.region")))
    typed = scans_of(layouts.typed_nodes(graph).where(filters.object_type_in("boolean")))
    assert typed.count("FileScan") == 1 and "labels.parquet" in typed


def test_subjects_reach_the_scan(spark, sf):
    graph = graph_of_tables(spark, sf).subjects([3 * 10_000_000 + 6])
    assert "EqualTo(c_custkey,5)" in scans_of(layouts.wide_nodes(graph))
    assert layouts.wide_nodes(graph).count() == 1 and layouts.typed_triples(graph).count() == 5


def test_wide_reads_only_what_is_asked(spark, sf):
    plan = scans_of(layouts.wide_nodes(graph_of_tables(spark, sf)).where(filters.wide_not_null("brand")).select("subject", "brand"))
    assert plan.count("FileScan") == 1 and "p_partkey:bigint,p_brand:string>" in plan


def test_edges_and_nodes_are_the_triples(spark, sf):
    graph = graph_of_tables(spark, sf)
    assert layouts.edges(graph).count() + layouts.typed_nodes(graph).count() == layouts.typed_triples(graph).count()


def test_parts_are_a_disjoint_cover(spark, sf):
    install()
    reader = spark.read.loom.option("loomgraph.partitioner.uidRange.uidsPerPartition", 20_000_000).option("loomgraph.partitioner.predicate.predicatesPerPartition", 4)
    state = state_of_tables(reader.max_uid(sf))
    parts = reader.planned_triples(state, sf).drop("part")
    whole = reader.triples(sf)
    assert parts.count() == whole.count() and parts.exceptAll(whole).isEmpty()


def test_reader_options(spark, sf):
    install()
    read = spark.read.loom
    assert read.option("loomgraph.nodes.mode", "wide").nodes(sf).columns[0] == "subject"
    assert read.option("loomgraph.triples.mode", "string").triples(sf).columns == ["subject", "predicate", "objectString", "objectType"]
    assert read.option("loomgraph.exclude.reserved-predicates", "graph.*").nodes(sf).where("predicate like 'graph.%'").isEmpty()
    assert read.option("path", sf).edges().count() == read.edges(sf).count() == read.links(sf).count()
    assert "graph_type" in read.vertices(sf).columns and "name" in read.schema(sf).by_name
    with pytest.raises(ValueError):
        read.option("loomgraph.nodes.mode", "other").nodes(sf)
    with pytest.raises(ValueError):
        read.edges()


@pytest.fixture(scope="module")
def film(spark):
    return graph_of_results(spark.createDataFrame([(results(),)], "value string"), SCHEMA)


def test_stored_graph(spark, film, tmp_path):
    path = str(tmp_path / "graph")
    write_graph(film, path, 3)
    again = read_graph(spark, path)
    assert again.schema == SCHEMA
    for layout in (layouts.typed_triples, layouts.string_triples, layouts.typed_nodes, layouts.edges, layouts.wide_nodes):
        a, b = layout(film), layout(again)
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
    register_formats(spark)
    assert spark.read.format("loomgraph-triples").load(path).exceptAll(layouts.typed_triples(film)).isEmpty()
    assert spark.read.format("loomgraph-nodes").load(path).count() == 49
    assert spark.read.format("loomgraph-edges").load(path).where("objectUid = 1").count() == 3
    install()
    assert spark.read.loom.triples(path).count() == 61


def test_read_transaction(spark, film, tmp_path):
    path = str(tmp_path / "moving")
    write_graph(film, path)
    install()
    before = spark.read.loom.option("loomgraph.transaction.mode", "read").graph(path)
    write_graph(film.only(["name"]), path)
    spark.catalog.refreshByPath(path)
    assert layouts.typed_triples(before).count() == 61
    assert spark.read.loom.triples(path).count() == 6


def test_medians(spark):
    rows = spark.createDataFrame([(i,) for i in (1, 2, 4, 8, 16)], "subject long")
    assert paging.upper_median_gap(rows).first().median == 4
    assert paging.upper_median_gap(rows.limit(1)).first().median is None


def test_unsigned_ranges(spark, film):
    rows = layouts.typed_triples(film)
    ordered = [r.subject for r in rows.select("subject").distinct().orderBy(unsigned_order(F.col("subject"))).collect()]
    assert ordered[-1] == TREK and ordered[0] == 1
    high = Part((), frozenset(SCHEMA.by_name), (10, 1 << 64))
    assert {r.subject for r in partitioned.read_part(film, high).collect()} == {TREK}
    low = Part((), frozenset(SCHEMA.by_name), (2, 5), frozenset({2, 3, 9}))
    assert {r.subject for r in partitioned.read_part(film, low).collect()} == {2, 3}


def test_scalar_functions(spark):
    one = spark.createDataFrame([("0xa7eb7890d6db0f1f", "1977-05-25T01:02:03.5+02:00", [1, 2, 3])], "u string, t string, a array<int>")
    r = one.select(uid_from_hex(F.col("u")), parse_timestamp(F.col("t")).cast("string"), rotated_array(F.col("a"), 1), rotated_array(F.col("a"), -1), rotated_array(F.array().cast("array<int>"), 2)).first()
    assert tuple(r) == (TREK, "1977-05-25 01:02:03.5", [2, 3, 1], [3, 1, 2], [])


def test_metrics(spark, film):
    rows, seen = partitioned.observed(layouts.typed_triples(film), "film")
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 61 and seen.get["subjects"] == 10 and seen.get["chars"] > 0


def test_paging(spark):
    rows = spark.createDataFrame([(i * 7,) for i in range(1, 40)], "subject long")
    assert [r.subject for r in paging.page(rows, 14, 3).orderBy("subject").collect()] == [21, 28, 35]
    assert paging.page(rows, 14, 100, 30).count() == 2
    assert {r.gap for r in paging.gaps(rows).collect()} == {7}
    assert [r.chunk for r in paging.chunk_ids(rows, 10).orderBy("subject").collect()] == [i // 10 for i in range(39)]
    assert paging.prober(rows)(20, 2) == [21, 28]
    assert [tuple(r) for r in paging.dense_runs(rows, 8).collect()] == [(7, 273, 39)]
    with pytest.raises(ValueError):
        paging.page(rows, 0, 0)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_numbers_do_not_depend_on_reused_exchanges(spark, reuse):
    """Gaps of 1 to 7 by a rule, rows in a mixed order, some of them twice."""
    n = 1_000_000
    mixed = spark.range(n + 1000).select(((F.col("id") * 7919) % n).alias("i"))
    rows = mixed.select((F.col("i") * 4 + F.col("i") % 4).alias("subject"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        wrong = paging.chunk_ids(rows, 1000).filter("chunk <> subject div 4000").count()
        counted = paging.chunk_ids(rows, 1000).count()
        own = {r.gap: r["count"] for r in paging.gaps(rows).groupBy("gap").count().collect()}
        median = paging.upper_median_gap(rows).first().median
        runs = paging.dense_runs(rows.filter("subject % 40000 >= 20000"), 100)
        found = [tuple(r) for r in runs.orderBy("first").collect()]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert (wrong, counted, median) == (0, n, 5)
    assert own == {5: n // 4 * 3, 1: n // 4 - 1}
    assert found == [(a + 20000, a + 39999, 5000) for a in range(0, 4 * n, 40000)]


def test_storage_needs_a_shared_folder(monkeypatch):
    class Session:
        conf = {}

        class sparkContext:
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_folder(Session)


def test_pushed_filters_reach_files(spark, film, tmp_path):
    path = str(tmp_path / "pushed")
    write_graph(film, path)
    reader = _Reader(path, TYPED_TRIPLES, None)
    left = list(reader.pushFilters([EqualTo(("predicate",), "title@en"), GreaterThan(("subject",), 7), EqualTo(("objectDouble",), 1.5), IsNotNull(("objectString",))]))
    assert [type(f).__name__ for f in left] == ["EqualTo"]
    assert {p.value.split("/")[-2] for p in reader.partitions()} == {"folder=title"}
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2  # films 8 and 9
    register_formats(spark)
    rows = spark.read.format("loomgraph-triples").load(path)
    for condition in ("predicate = 'title@en' AND subject > 7", "predicate IN ('name', 'title') AND subject < 8", "objectString = 'Han Solo'", "objectDouble > 5.4e8", "subject = 8 AND objectLong IS NOT NULL", "predicate = 'none'"):
        expected = layouts.typed_triples(film).where(condition)
        assert rows.where(condition).exceptAll(expected).isEmpty() and rows.where(condition).count() == expected.count()


def test_triangles(spark):
    ids = spark.createDataFrame([(i,) for i in range(6)], "id long")
    links = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 0), (2, 3), (3, 0), (4, 4)], "src long, dst long")
    assert {r.id: r.triangles for r in algorithms.triangle_count(ids, links).collect()} == {0: 2, 1: 1, 2: 2, 3: 1, 4: 0, 5: 0}


def test_hubs_of_pagerank(spark, monkeypatch):
    ids = spark.range(60).withColumnRenamed("id", "id")
    links = spark.range(59).selectExpr("0L AS src", "id + 1 AS dst").unionAll(spark.range(1, 60).selectExpr("id AS src", "(id * 7) % 60 AS dst"))
    plain = {r.id: r.pagerank for r in algorithms.pagerank(ids, links, 6).collect()}
    monkeypatch.setattr(algorithms, "HUB", 10)
    assert {r.id: r.pagerank for r in algorithms.pagerank(ids, links, 6).collect()} == pytest.approx(plain)


def test_empty_edges(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    links = spark.createDataFrame([], "src long, dst long")
    assert {r.pagerank for r in algorithms.pagerank(ids, links, 3).collect()} == {1.0}
    assert algorithms.triangle_count(ids, links).count() == 2


def test_event_stream(spark, sf, tmp_path):
    folder = tmp_path / "events"
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(folder))
    stream = windowed(read_events(spark, str(folder), 1), "1 day", late="3650 days")
    name = "event_counts"
    running = stream.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).start()
    running.processAllAvailable()
    running.stop()
    found = {(r.start, r.event_type): r.events for r in spark.table(name).collect()}
    expected = {(r.start, r.event_type): r.events for r in windowed(events, "1 day").collect()}
    assert found == expected and found
