from loomgraph.queries import QUERIES
from test_engine import ORACLE_SQL, oracle, rows_of  # noqa: F401


def test_whole_nodes(spark, sf, oracle):  # noqa: F811
    df = QUERIES["node_maps"](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    found = oracle.execute(ORACLE_SQL["node_maps"])
    assert rows_of(df.columns, rows) == rows_of([d[0] for d in found.description], found.fetchall())
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").collect()
    pairs = [p for _, _, p in rows]
    assert docs and all(any(f"text={d.text};text@{d.lang}={d.text}" in p for p in pairs) for d in docs[:20])
