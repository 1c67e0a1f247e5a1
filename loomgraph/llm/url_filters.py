"""URL filters: rules, and trust and distrust propagated over host links, in DataFrame functions only.

A rule gives the verdict on the URLs that it fits.  For the others, each host
gets a trust, its personalised PageRank over host links from the hosts of
allowed pages, and a distrust, the same over reversed links from the hosts of
blocked pages; seeds count by their pages.  A host whose distrust exceeds its
trust by more than a threshold is blocked, any other allowed, among them hosts
that neither reaches.

Host links are counted before anything is shuffled by host: the absolute and
scheme-relative anchors of the pages, and a link both ways between a host and
the domain above it, unless that has fewer than ``MIN_LABELS`` labels.

Edge cases: a null URL, or one without ``://``, has empty host and path, fits no
rule and links nowhere; a null page has no links; repeated rows count as often as they
occur; null ids pass through; an empty table gives an empty table; columns
other than the id, the URL and the page are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import discard, written

#: Weight of links against seeds, rounds, and the lead of distrust over trust that blocks a host.
DAMPING, ROUNDS, THRESHOLD = 0.85, 10, 0.0
#: Rounds after which the state is written to a table.
CUT = 5
MIN_LABELS = 3

#: The rules as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ANCHOR = r"""(?i)<a\s[^>]*href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fitting(rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits the columns host and path, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _propagated(seeds: DataFrame, links: DataFrame, damping: float, rounds: int) -> tuple[DataFrame, list[str]]:
    """Personalised PageRank: ``seeds`` (host, seed) with seeds that sum to one, ``links`` (a, b, share)."""
    ranks, paths = seeds.select("host", F.col("seed").alias("rank")), []
    for i in range(1, rounds + 1):
        moved = ranks.join(links, ranks["host"] == links["a"]).select(F.col("b").alias("host"), (F.lit(damping) * F.col("rank") * F.col("share")).alias("rank"))
        given = seeds.select("host", (F.lit(1 - damping) * F.col("seed")).alias("rank"))
        ranks = moved.unionAll(given).groupBy("host").agg(F.sum("rank").alias("rank"))
        if i % CUT == 0 or i == rounds:
            ranks, where = written(ranks, "ranks")
            paths.append(where)
    return ranks, paths


def _seeds(hosts: DataFrame, column: str) -> DataFrame:
    some = hosts.filter(F.col(column) > 0).select("host", F.col(column).cast("double").alias("n"))
    total = some.agg(F.sum("n").alias("total")).first()["total"]
    return some.select("host", (F.col("n") / F.lit(total or 1.0)).alias("seed"))


def _shares(links: DataFrame, a: str, b: str) -> DataFrame:
    """Links from ``a`` to ``b`` with their share of all that leave ``a``."""
    out = links.groupBy(a).agg(F.sum("n").alias("total"))
    return links.join(out, a).select(F.col(a).alias("a"), F.col(b).alias("b"), (F.col("n") / F.col("total")).alias("share"))


def host_scores(marked: DataFrame, min_labels: int = MIN_LABELS, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` of every host that either reaches, from columns host, page, by_rule."""
    spark = marked.sparkSession
    named = marked.filter("host <> ''")
    hosts, hosts_path = written(
        named.groupBy("host").agg(
            F.count_if(F.col("by_rule") == "allow").alias("allowed"), F.count_if(F.col("by_rule") == "block").alias("blocked")
        ),
        "hosts",
    )
    anchors = (
        named.select("host", F.explode(F.regexp_extract_all("page", F.lit(_ANCHOR), 1)).alias("target"))
        .select("host", F.translate("target", _UPPER, _LOWER).alias("target"))
        .groupBy("host", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    above = F.expr("substring(host, instr(host, '.') + 1)")
    domains = hosts.filter(F.size(F.split("host", r"\.")) > min_labels).select("host", above.alias("target"))
    both = domains.unionAll(domains.select("target", "host")).withColumn("n", F.lit(1).cast("long"))
    links, links_path = written(
        anchors.unionAll(both).filter("host <> target").groupBy("host", "target").agg(F.sum("n").alias("n")), "links"
    )
    forward, forward_path = written(_shares(links, "host", "target"), "forward")
    back, back_path = written(_shares(links, "target", "host"), "back")
    trust, trust_paths = _propagated(_seeds(hosts, "allowed"), forward, damping, rounds)
    distrust, distrust_paths = _propagated(_seeds(hosts, "blocked"), back, damping, rounds)
    scores, _ = written(
        trust.withColumnRenamed("rank", "trust")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
        .select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")),
        "scores",
    )
    discard(spark, hosts_path, links_path, forward_path, back_path, *trust_paths, *distrust_paths)
    return scores


def judge(
    df: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    page_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row's id, ``host``, ``path``, ``rule`` and ``verdict``."""
    url = F.col(f"`{url_col}`")
    parted = df.select(F.col(f"`{id_col}`").alias("page_id"), host(url).alias("host"), path(url).alias("path"), F.col(f"`{page_col}`").alias("page"))
    rule, verdict = _fitting(rules)
    marked = parted.withColumn("rule", rule).withColumn("by_rule", verdict)
    scores = host_scores(marked)
    blocked = scores.filter(F.round(F.col("distrust") - F.col("trust"), 9) > threshold).select("host", F.lit("block").alias("by_host"))
    return (
        marked.drop("page")
        .join(blocked, "host", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"))
    )


def oracle_sql(rules: tuple[tuple[str, str, str], ...] = RULES) -> str:
    """The same for table ``pages``, in DuckDB's SQL, round by round."""
    fits = lambda name, start: f"((host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{start}'))"
    by_length = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(n, p)} THEN '{n}{p}'" for _, n, p in by_length) + " END"
    says = "CASE " + " ".join(f"WHEN {fits(n, p)} THEN '{v}'" for v, n, p in by_length) + " END"
    parts = [
        rf"""parted AS (SELECT page_id, html,
            translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
        f"marked AS (SELECT *, {rule} AS rule, {says} AS by_rule FROM parted)",
        """hosts AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS allowed, count(*) FILTER (by_rule = 'block') AS blocked
            FROM marked WHERE host <> '' GROUP BY host)""",
        f"""anchors AS (SELECT host, translate(unnest(regexp_extract_all(html, '{_ANCHOR.replace("'", "''")}', 1)), '{_UPPER}', '{_LOWER}') AS target
            FROM marked WHERE host <> '')""",
        f"""domains AS (SELECT host, substr(host, instr(host, '.') + 1) AS target FROM hosts
            WHERE len(string_split(host, '.')) > {MIN_LABELS})""",
        """links AS (SELECT host, target, count(*) AS n FROM (SELECT * FROM anchors UNION ALL SELECT host, target FROM domains
            UNION ALL SELECT target, host FROM domains) WHERE host <> target GROUP BY ALL)""",
        "forward AS (SELECT host AS a, target AS b, n / sum(n) OVER (PARTITION BY host) AS share FROM links)",
        "back AS (SELECT target AS a, host AS b, n / sum(n) OVER (PARTITION BY target) AS share FROM links)",
    ]
    for name, column, links in (("t", "allowed", "forward"), ("d", "blocked", "back")):
        parts.append(f"{name}s AS (SELECT host, {column} / sum({column}) OVER () AS seed FROM hosts WHERE {column} > 0)")
        parts.append(f"{name}0 AS (SELECT host, seed AS rank FROM {name}s)")
        for i in range(ROUNDS):
            parts.append(
                f"""{name}{i + 1} AS MATERIALIZED (SELECT host, sum(rank) AS rank FROM (
                    SELECT b AS host, {DAMPING} * rank * share AS rank FROM {name}{i} JOIN {links} ON a = host
                    UNION ALL SELECT host, {1 - DAMPING} * seed FROM {name}s) GROUP BY host)"""
            )
    parts.append(
        f"""by_host AS (SELECT host FROM t{ROUNDS} t FULL JOIN d{ROUNDS} d USING (host)
            WHERE round(coalesce(d.rank, 0) - coalesce(t.rank, 0), 9) > {THRESHOLD})"""
    )
    return (
        "WITH "
        + ",\n".join(parts)
        + """
        SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN host IN (FROM by_host) THEN 'block' ELSE 'allow' END) AS verdict FROM marked"""
    )
