"""URL filter: written rules first, then trust and distrust propagated over the host graph.

Trust is a personalised PageRank from the allowed seed hosts along links; distrust is one from
the blocked seed hosts against them, since a page answers for what it links to. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import pages, stored, unpacked, whole_rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
DAMPING = 0.85
ITERATIONS = 20
SEED_SHARE = 0.5  # of a host's pages that rules of one verdict must cover to make it a seed
MARGIN = 0.0  # a host is blocked if its distrust exceeds its trust by more
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"
_STEPS_PER_WRITE = 5


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 2)


def matched_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule whose host the host is or lies under and whose path begins the path."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = (host == name) | F.endswith(host, F.lit("." + name))
        found = F.when(fits & F.startswith(path, F.lit(slash + rest)), rule).otherwise(found)
    return found


def host_links(docs: DataFrame) -> DataFrame:
    """(src, dst, n): how often pages of one host link to another, counted per host pair."""
    targets = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), 1)))
    links = docs.select(F.col("host").alias("src"), targets.alias("dst"))
    links = links.withColumn("dst", F.translate("dst", UPPER, LOWER))
    return (
        links.filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def propagate(
    links: DataFrame, seeds: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS
) -> DataFrame:
    """(walk, host, rank) for the walks trust and distrust, both in one pass per step.

    ``seeds`` has (walk, host, mass) with mass summing to 1 per walk. A step moves the damped rank
    of a host over its links in proportion to their number and adds the seeds' part again; rank
    at a host without links is not passed on. Ranks go to the shared folder every few steps.
    """
    forward = links.select(F.lit("trust").alias("walk"), "src", "dst", "n")
    reverse = links.select(
        F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"
    )
    both = forward.unionByName(reverse)
    out = both.groupBy("walk", "src").agg(F.sum("n").alias("all"))
    edges = stored(
        both.join(out, ["walk", "src"]).select(
            "walk", "src", "dst", (F.col("n") / F.col("all")).alias("share")
        ),
        "host-edges",
    )
    start = seeds.select("walk", "host", (F.col("mass") * (1 - damping)).alias("rank"))
    ranks = seeds.select("walk", "host", F.col("mass").alias("rank"))
    if edges.isEmpty():
        return ranks
    for step in range(iterations):
        moved = (
            ranks.withColumnRenamed("host", "src")
            .join(edges, ["walk", "src"])
            .select(
                "walk", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")
            )
        )
        ranks = moved.unionByName(start).groupBy("walk", "host").agg(F.sum("rank").alias("rank"))
        if step % _STEPS_PER_WRITE == _STEPS_PER_WRITE - 1:
            ranks = stored(ranks, f"ranks-{step}")
    return ranks


def judge_urls(
    docs: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    damping: float = DAMPING,
    iterations: int = ITERATIONS,
    seed_share: float = SEED_SHARE,
    margin: float = MARGIN,
) -> DataFrame:
    """Columns of the pages with ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``.

    The verdict is the longest fitting rule's; without one it is block where the host's distrust
    exceeds its trust by more than ``margin``, else allow. A seed is a host of whose pages rules
    of one verdict cover at least ``seed_share``; each seed weighs as many pages as they cover.
    Null urls and such without ``://`` have empty host and path, fit no rule and are allowed;
    null html has no links; repeated rows are judged alike. Columns named like results are
    replaced. An empty table gives no rows.
    """
    host, path = F.col("host"), F.col("path")
    verdicts = F.create_map(*[F.lit(x) for pair in rules for x in pair])
    judged = docs.select(
        whole_rows(docs),
        "html",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    ).withColumn("rule", matched_rule(host, path, rules))
    ruled = F.element_at(verdicts, F.col("rule"))
    sides = stored(
        judged.filter(host != "")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count(F.when(ruled == "allow", 1)).alias("trust"),
            F.count(F.when(ruled == "block", 1)).alias("distrust"),
        ),
        "hosts",
    )
    seeds = sides.select(
        "host", "pages", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (walk, n)")
    ).filter((F.col("n") > 0) & (F.col("n") >= seed_share * F.col("pages")))
    total = seeds.groupBy("walk").agg(F.sum("n").alias("all"))
    seeds = stored(
        seeds.join(total, "walk").select("walk", "host", (F.col("n") / F.col("all")).alias("mass")),
        "seeds",
    )
    ranks = propagate(stored(host_links(judged), "host-links"), seeds, damping, iterations)
    scores = ranks.groupBy(F.col("host").alias("h_")).agg(
        *[
            F.sum(F.when(F.col("walk") == w, F.col("rank")).otherwise(0.0)).alias(w)
            for w in ("trust", "distrust")
        ]
    )
    scores = stored(scores, "host-scores")
    trust, distrust = (F.coalesce(F.col(w), F.lit(0.0)) for w in ("trust", "distrust"))
    spread = F.when(distrust - trust > margin, "block").otherwise("allow")
    results = {
        "host": host,
        "path": path,
        "rule": F.col("rule"),
        "verdict": F.coalesce(ruled, spread),
        "trust": trust,
        "distrust": distrust,
    }
    own = [c for c in docs.columns if c not in results]
    return judged.join(scores, host == F.col("h_"), "left").select(
        *unpacked(own), *[c.alias(name) for name, c in results.items()]
    )


def op6_link_graph_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(pages(spark, sf_dir)).select(
        "page_id", "host", "path", "rule", "verdict", "trust", "distrust"
    )


def _op6_sql() -> str:
    """The same judgement in SQL, a step of the walks per common table."""
    names = sorted(RULES, key=lambda r: (-len(r[0]), r[0]))
    cases = []
    for rule, _ in names:
        name, slash, rest = rule.partition("/")
        cases.append(
            f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) "
            f"AND starts_with(path, '{slash + rest}') THEN '{rule}'"
        )
    verdicts = " ".join(f"WHEN '{rule}' THEN '{verdict}'" for rule, verdict in names)
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    link = _LINK.replace("'", "''")
    steps = []
    for i in range(ITERATIONS):
        steps.append(
            f"""r{i + 1} AS (
  SELECT walk, host, sum(rank) AS rank FROM (
    SELECT e.walk, e.dst AS host, r.rank * e.share * {DAMPING}::DOUBLE AS rank
    FROM r{i} r JOIN edges e ON r.walk = e.walk AND r.host = e.src
    UNION ALL SELECT walk, host, mass * (1 - {DAMPING}::DOUBLE) FROM seeds) GROUP BY ALL)"""
        )
    return f"""
WITH u AS (
  SELECT page_id, html, {lower.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's')")}
      AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages
), j AS (
  SELECT *, CASE {" ".join(cases)} END AS rule, CASE rule {verdicts} END AS ruled FROM u
), s AS (
  SELECT host, walk, count(*) AS pages, count(*) FILTER (WHERE ruled = verdict) AS n
  FROM j, (VALUES ('trust', 'allow'), ('distrust', 'block')) w(walk, verdict)
  WHERE host <> '' GROUP BY ALL
), seeds AS (
  SELECT walk, host, n / sum(n) OVER (PARTITION BY walk) AS mass
  FROM s WHERE n > 0 AND n >= {SEED_SHARE} * pages
), l AS (
  SELECT host AS src, {lower.format("unnest(list_distinct(regexp_extract_all(html, t, 1)))")} AS dst
  FROM j, (SELECT '{link}' AS t)
), g AS (
  SELECT src, dst, count(*) AS n FROM l WHERE src <> '' AND src <> dst GROUP BY ALL
), edges AS (
  SELECT walk, src, dst, n / sum(n) OVER (PARTITION BY walk, src) AS share FROM (
    SELECT 'trust' AS walk, src, dst, n FROM g
    UNION ALL SELECT 'distrust', dst, src, n FROM g)
), r0 AS (SELECT walk, host, mass AS rank FROM seeds),
{", ".join(steps)},
ranks AS (
  SELECT * FROM r{ITERATIONS} WHERE EXISTS (FROM edges)
  UNION ALL SELECT * FROM r0 WHERE NOT EXISTS (FROM edges)
), h AS (
  SELECT host, sum(CASE WHEN walk = 'trust' THEN rank ELSE 0 END) AS trust,
    sum(CASE WHEN walk = 'distrust' THEN rank ELSE 0 END) AS distrust
  FROM ranks GROUP BY host
)
SELECT page_id, j.host, path, rule,
  coalesce(ruled, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0) > {MARGIN} THEN 'block'
    ELSE 'allow' END) AS verdict,
  coalesce(trust, 0)::DOUBLE AS trust, coalesce(distrust, 0)::DOUBLE AS distrust
FROM j LEFT JOIN h ON j.host = h.host
"""


OP6_SQL = _op6_sql()
