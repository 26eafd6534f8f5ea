"""Registered queries: supplier network and trade lanes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import durable
from wharfline.operators import network
from wharfline.operators.aggregates import edge_weights
from wharfline.plans.order_queries import rounded
from wharfline.plans.registry import query
from wharfline.plans.sql_views import EDGES, FACTS, LANES, WHOLE_LANES, with_view
from wharfline.sources import views


def supply(spark: SparkSession, folder: str) -> DataFrame:
    """Stored, as a search reads its edges several times and all order lines lie behind them."""
    return durable(edge_weights(views.supply_edges(spark, folder), "src", "dst", "weight"))


def lanes(spark: SparkSession, folder: str) -> DataFrame:
    """The lanes heavier than the mean."""
    return durable(views.busy_lanes(views.trade_lanes(spark, folder)))


def whole_lanes(spark: SparkSession, folder: str) -> DataFrame:
    return durable(views.trade_lanes(spark, folder))


def _recursive(view: str, body: str = "") -> str:
    return "WITH RECURSIVE " + view.strip() + body


def lane_query(name: str, body: str | None = None, statement: Callable[[str, str], str] = with_view):
    """Register a query of edges twice: as ``busy_...`` over the heavier lanes, and as ``whole_...`` over all of them."""

    def register(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        for prefix, view, edges in (("busy_", LANES, lanes), ("whole_", WHOLE_LANES, whole_lanes)):
            sql = None if body is None else statement(view, body)
            query(prefix + name, sql)(lambda spark, folder, edges=edges: fn(edges(spark, folder)))
        return fn

    return register


@query(
    "last_shipment_edges",
    with_view(
        FACTS,
        """
SELECT src, dst, weight, product FROM (
  SELECT 'S' || supplier_id AS src, 'C' || retailer_id AS dst, quantity AS weight, product,
         row_number() OVER (PARTITION BY supplier_id, retailer_id
           ORDER BY delivery_date DESC, order_id DESC, line_number DESC, quantity DESC, product DESC) AS rn
  FROM facts) WHERE rn = 1""",
    ),
)
def last_shipment_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier to customer, each pair with the figures of its last shipment."""
    rows = views.order_facts(spark, folder).withColumns(
        {
            "source": F.concat(F.lit("S"), F.col("supplier_id").cast("string")),
            "target": F.concat(F.lit("C"), F.col("retailer_id").cast("string")),
        }
    )
    return network.build_edges(
        rows, "source", "target", "quantity", ["product"], ["delivery_date", "order_id", "line_number"]
    )


@lane_query(
    "undirected_lanes",
    "\nSELECT least(src, dst) AS src, greatest(src, dst) AS dst, arg_max(weight, (src, dst)) AS weight FROM lanes GROUP BY 1, 2",
)
def undirected_lanes(edges: DataFrame) -> DataFrame:
    """Lanes without direction; of the two ways of a pair the later by name is kept."""
    return network.build_edges(edges, "src", "dst", "weight", order=["src", "dst"], directed=False)


@query(
    "network_nodes",
    with_view(EDGES, "\nSELECT src AS node FROM edges UNION SELECT dst FROM edges"),
)
def network_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return network.node_set(supply(spark, folder))


@query(
    "edge_widths",
    with_view(EDGES, "\nSELECT src, dst, weight, round(3 * weight / (SELECT max(weight) FROM edges), 6) AS width FROM edges"),
)
def edge_widths(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(network.relative_width(supply(spark, folder)), 6)


DEGREES = """,
ends AS (
  SELECT src AS node, 0 AS i, 1 AS o, 0.0::DOUBLE AS wi, weight AS wo FROM {edges}
  UNION ALL SELECT dst, 1, 0, weight, 0.0::DOUBLE FROM {edges}
),
degrees AS (
  SELECT node, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree, sum(i + o)::BIGINT AS degree,
         sum(wi) AS weighted_in, sum(wo) AS weighted_out
  FROM ends GROUP BY 1
)
"""


@query("node_degrees", with_view(EDGES, DEGREES.format(edges="edges") + "SELECT * FROM degrees"))
def node_degrees(spark: SparkSession, folder: str) -> DataFrame:
    return network.degrees(supply(spark, folder))


@query(
    "degree_centrality",
    with_view(
        EDGES,
        DEGREES.format(edges="edges")
        + """SELECT node, round(degree / (n - 1), 8) AS degree_centrality, round(in_degree / (n - 1), 8) AS in_degree_centrality,
       round(out_degree / (n - 1), 8) AS out_degree_centrality
FROM degrees, (SELECT count(*)::DOUBLE AS n FROM degrees)""",
    ),
)
def degree_centrality(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(network.degree_centrality(supply(spark, folder)), 8)


@query(
    "supply_path_metrics",
    with_view(
        EDGES,
        DEGREES.format(edges="edges")
        + """,
size AS (SELECT count(*)::DOUBLE AS n FROM degrees),
reach AS (
  SELECT dst AS node, src AS source, 1 AS d FROM edges
  UNION SELECT b.dst, a.src, 2 FROM edges a JOIN edges b ON a.dst = b.src
),
near AS (SELECT node, count(*)::DOUBLE AS r, sum(d)::DOUBLE AS s FROM (SELECT node, source, min(d) AS d FROM reach GROUP BY 1, 2) GROUP BY 1)
SELECT degrees.node, round(in_degree * out_degree / ((n - 1) * (n - 2)), 8) AS betweenness,
       round(coalesce(r / s * r / (n - 1), 0), 8) AS closeness,
       coalesce(s, 0)::BIGINT AS distance_sum, coalesce(r, 0)::BIGINT AS reached_from
FROM degrees CROSS JOIN size LEFT JOIN near USING (node)""".replace("\n,\nsize", ",\nsize"),
    ),
)
def supply_path_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Betweenness and closeness; every path through a nation is the only one between its ends."""
    return rounded(network.path_metrics(supply(spark, folder)), 8)


# Distances by a walk over the lanes, then shortest paths counted level by level.
LANE_PATHS = """,
names AS (SELECT src AS node FROM lanes UNION SELECT dst FROM lanes),
size AS (SELECT count(*)::DOUBLE AS n FROM names),
walks AS (
  SELECT src AS s, dst AS t, 1 AS d FROM lanes
  UNION SELECT walks.s, lanes.dst, walks.d + 1 FROM walks JOIN lanes ON walks.t = lanes.src WHERE walks.d < 24
),
dist AS MATERIALIZED (SELECT s, t, min(d) AS d FROM walks WHERE s <> t GROUP BY 1, 2),
counted AS (
  SELECT node AS s, node AS t, 0 AS d, 1.0::DOUBLE AS paths FROM names
  UNION ALL
  SELECT c.s, l.dst, c.d + 1, sum(c.paths)
  FROM counted c JOIN lanes l ON c.t = l.src JOIN dist x ON x.s = c.s AND x.t = l.dst AND x.d = c.d + 1
  GROUP BY c.s, l.dst, c.d
),
shortest AS MATERIALIZED (SELECT * FROM counted WHERE d > 0),
through AS (
  SELECT a.t AS node, sum(a.paths * b.paths / w.paths) AS delta
  FROM shortest a JOIN shortest b ON a.t = b.s JOIN shortest w ON w.s = a.s AND w.t = b.t AND w.d = a.d + b.d GROUP BY 1
),
near AS (SELECT t AS node, count(*) AS r, sum(d)::BIGINT AS s FROM dist GROUP BY 1),
paths AS (
  SELECT names.node, coalesce(delta, 0) / ((n - 1) * (n - 2)) AS betweenness, coalesce(r::DOUBLE / s * r / (n - 1), 0) AS closeness,
         coalesce(s, 0) AS distance_sum, coalesce(r, 0) AS reached_from
  FROM names CROSS JOIN size LEFT JOIN near USING (node) LEFT JOIN through USING (node)
)
"""


@lane_query(
    "lane_path_metrics",
    LANE_PATHS
    + "SELECT node, round(betweenness, 8) AS betweenness, round(closeness, 8) AS closeness, distance_sum, reached_from FROM paths",
    _recursive,
)
def lane_path_metrics(edges: DataFrame) -> DataFrame:
    return rounded(network.path_metrics(edges), 8)


@lane_query(
    "lane_average_path",
    """,
names AS (SELECT src AS node FROM lanes UNION SELECT dst FROM lanes),
walks AS (
  SELECT src AS s, dst AS t, 1 AS d FROM lanes
  UNION SELECT walks.s, lanes.dst, walks.d + 1 FROM walks JOIN lanes ON walks.t = lanes.src WHERE walks.d < 24
),
dist AS (SELECT s, t, min(d) AS d FROM walks WHERE s <> t GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM names)
SELECT count(*) = max(n * (n - 1)) AS strongly_connected,
       CASE WHEN count(*) = max(n * (n - 1)) THEN round(avg(d), 8) END AS average_path_length
FROM dist, n""",
    _recursive,
)
def lane_average_path(edges: DataFrame) -> DataFrame:
    return rounded(network.average_path_length(network.path_metrics(edges)), 8)


@lane_query("lane_eigenvector")
def lane_eigenvector(edges: DataFrame) -> DataFrame:
    return rounded(network.eigenvector_centrality(edges), 6)


@lane_query(
    "lane_eigenvector_limit",
    """,
names AS (SELECT src AS node FROM lanes UNION SELECT dst FROM lanes),
moved AS (
  SELECT 0 AS k, node, 1.0::DOUBLE AS x FROM names
  UNION ALL
  SELECT k + 1, node, v / sqrt(sum(v * v) OVER ())
  FROM (SELECT k, node, sum(x) AS v FROM (
    SELECT k, node, x FROM moved WHERE k < 400
    UNION ALL SELECT k, dst, x FROM moved JOIN lanes ON src = node WHERE k < 400) GROUP BY k, node)
)
SELECT node, round(x, 6) AS eigenvector, true AS converged FROM moved WHERE k = 400""",
    _recursive,
)
def lane_eigenvector_limit(edges: DataFrame) -> DataFrame:
    """Iterated until nothing moves but rounding."""
    return rounded(network.eigenvector_centrality(edges, tolerance=1e-13), 6)


@query(
    "customer_order_components",
    """WITH RECURSIVE
ways AS (
  SELECT 'C' || o_custkey AS a, 'O' || o_orderkey AS b FROM orders UNION SELECT 'O' || o_orderkey, 'C' || o_custkey FROM orders
),
reach AS (
  SELECT a AS node, a AS other FROM ways
  UNION SELECT reach.node, ways.b FROM reach JOIN ways ON reach.other = ways.a
)
SELECT node, min(other) AS component FROM reach GROUP BY 1""",
)
def customer_order_components(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of customers and orders: one per customer that orders."""
    edges = views.table(spark, folder, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("dst"),
    )
    return network.components(edges)


@query(
    "order_product_components",
    """WITH RECURSIVE
ways AS (
  SELECT 'O' || l_orderkey AS a, 'P' || l_partkey AS b FROM lineitem UNION SELECT 'P' || l_partkey, 'O' || l_orderkey FROM lineitem
),
labels(hop, node, label) AS (
  SELECT DISTINCT 0, a, a FROM ways
  UNION ALL
  SELECT hop + 1, node, min(label) FROM (
    SELECT hop, node, label FROM labels WHERE hop < 24
    UNION ALL SELECT hop, b, label FROM labels JOIN ways ON node = a WHERE hop < 24
  ) GROUP BY hop, node
)
SELECT node, label AS component FROM labels WHERE hop = 24""",
)
def order_product_components(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of orders and products linked by order lines."""
    edges = views.table(spark, folder, "lineitem").select(
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("src"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("dst"),
    )
    return network.components(edges)


@query(
    "supply_features",
    with_view(
        EDGES,
        DEGREES.format(edges="edges").rstrip()
        + """,
size AS (SELECT count(*)::DOUBLE AS n FROM degrees),
reach AS (
  SELECT dst AS node, src AS source, 1 AS d FROM edges
  UNION SELECT b.dst, a.src, 2 FROM edges a JOIN edges b ON a.dst = b.src
),
near AS (SELECT node, count(*)::DOUBLE AS r, sum(d)::DOUBLE AS s FROM (SELECT node, source, min(d) AS d FROM reach GROUP BY 1, 2) GROUP BY 1),
features AS (
  SELECT degrees.*, round(in_degree * out_degree / ((n - 1) * (n - 2)), 8) AS b, round(coalesce(r / s * r / (n - 1), 0), 8) AS c
  FROM degrees CROSS JOIN size LEFT JOIN near USING (node)
)
SELECT src, dst, round(weight, 8) AS weight, f.out_degree AS src_out_degree, f.b AS src_betweenness, f.c AS src_closeness,
       round(f.weighted_out, 8) AS src_weighted_out, t.in_degree AS dst_in_degree, t.b AS dst_betweenness, t.c AS dst_closeness,
       round(t.weighted_in, 8) AS dst_weighted_in
FROM edges JOIN features f ON src = f.node JOIN features t ON dst = t.node""",
    ),
)
def supply_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(network.network_features(supply(spark, folder), "src", "dst", "weight"), 8)


@lane_query("lane_communities")
def lane_communities(edges: DataFrame) -> DataFrame:
    return rounded(network.communities(edges), 6)


@lane_query("lane_critical_nodes")
def lane_critical_nodes(edges: DataFrame) -> DataFrame:
    """The ten first nodes of every metric."""
    critical = network.critical_nodes(network.centrality_metrics(edges))
    return rounded(critical, 6)


@lane_query(
    "lane_consensus_nodes",
    LANE_PATHS.rstrip()
    + DEGREES.format(edges="lanes").rstrip()
    + """,
scored AS (
  SELECT node, 'd' AS metric, degree / (n - 1) AS score FROM degrees, size
  UNION ALL SELECT node, 'i', in_degree / (n - 1) FROM degrees, size
  UNION ALL SELECT node, 'o', out_degree / (n - 1) FROM degrees, size
  UNION ALL SELECT node, 'b', betweenness FROM paths
  UNION ALL SELECT node, 'c', closeness FROM paths
),
ranked AS (SELECT node, row_number() OVER (PARTITION BY metric ORDER BY round(score, 12) DESC, node) AS rn FROM scored)
SELECT node, count(*) AS votes, round(count(*) / 5, 6) AS score FROM ranked WHERE rn <= 10 GROUP BY 1 HAVING count(*) > 1""",
    _recursive,
)
def lane_consensus_nodes(edges: DataFrame) -> DataFrame:
    metrics = network.centrality_metrics(edges, eigenvector=False)
    return rounded(network.consensus_nodes(network.critical_nodes(metrics)), 6)


RESILIENCE = """,
votes AS (
  SELECT node, count(*) AS votes FROM (
    SELECT node, row_number() OVER (ORDER BY degree DESC, node) AS rn FROM degrees
    UNION ALL SELECT node, row_number() OVER (ORDER BY in_degree DESC, node) FROM degrees
    UNION ALL SELECT node, row_number() OVER (ORDER BY out_degree DESC, node) FROM degrees
    UNION ALL SELECT node, row_number() OVER (ORDER BY round(in_degree * out_degree / ((n - 1) * (n - 2)), 12) DESC, node)
              FROM degrees, (SELECT count(*)::DOUBLE AS n FROM degrees)
    UNION ALL SELECT node, row_number() OVER (ORDER BY round(coalesce(r / s * r, 0), 8) DESC, node)
              FROM degrees LEFT JOIN near USING (node)
  ) WHERE rn <= 10 GROUP BY 1 HAVING count(*) > 1
),
gone AS (SELECT node FROM votes ORDER BY votes DESC, node LIMIT 5),
kept AS (SELECT src, dst FROM edges WHERE src NOT IN (SELECT node FROM gone) AND dst NOT IN (SELECT node FROM gone)),
kept_nodes AS (SELECT node FROM degrees WHERE node NOT IN (SELECT node FROM gone)),
kept_reach AS (
  SELECT dst AS node, src AS source, 1 AS d FROM kept
  UNION SELECT b.dst, a.src, 2 FROM kept a JOIN kept b ON a.dst = b.src
),
way AS (SELECT sum(r) AS pairs, sum(s) AS length FROM near),
kept_way AS (
  SELECT count(*) AS pairs, sum(d)::DOUBLE AS length FROM (SELECT node, source, min(d) AS d FROM kept_reach GROUP BY 1, 2)
),
ways AS (SELECT src AS a, dst AS b FROM kept UNION SELECT dst, src FROM kept UNION SELECT node, node FROM kept_nodes),
joined AS (SELECT a AS node, a AS other FROM ways UNION SELECT joined.node, ways.b FROM joined JOIN ways ON joined.other = ways.a),
after AS (SELECT count(DISTINCT c) AS c FROM (SELECT node, min(other) AS c FROM joined GROUP BY 1)),
all_ways AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
all_joined AS (SELECT a AS node, a AS other FROM all_ways UNION SELECT all_joined.node, all_ways.b FROM all_joined JOIN all_ways ON all_joined.other = all_ways.a),
before AS (SELECT count(DISTINCT c) AS c FROM (SELECT node, min(other) AS c FROM all_joined GROUP BY 1)),
n AS (SELECT count(*) AS n, (SELECT count(*) FROM kept_nodes) AS kn, (SELECT count(*) FROM edges) AS m,
             (SELECT count(*) FROM kept) AS km FROM degrees)
SELECT n AS nodes, m AS edges, before.c AS components,
       CASE WHEN way.pairs = n * (n - 1) THEN round(way.length / way.pairs, 6) END AS average_path_length,
       CASE WHEN kept_way.pairs = kn * (kn - 1) THEN round(kept_way.length / kept_way.pairs, 6) END AS average_path_length_after,
       round(100.0 * (n - kn) / n, 6) AS node_loss_percentage,
       round(100.0 * (m - km) / m, 6) AS edge_loss_percentage, after.c - before.c AS fragmentation_increase,
       (SELECT string_agg(node, ',' ORDER BY node) FROM gone) AS nodes_removed
FROM n, before, after, way, kept_way"""


@query(
    "supply_resilience",
    _recursive(EDGES)
    + DEGREES.format(edges="edges").rstrip()
    + """,
reach AS (
  SELECT dst AS node, src AS source, 1 AS d FROM edges
  UNION SELECT b.dst, a.src, 2 FROM edges a JOIN edges b ON a.dst = b.src
),
near AS (SELECT node, count(*)::DOUBLE AS r, sum(d)::DOUBLE AS s FROM (SELECT node, source, min(d) AS d FROM reach GROUP BY 1, 2) GROUP BY 1)"""
    + RESILIENCE,
)
def supply_resilience(spark: SparkSession, folder: str) -> DataFrame:
    """The supply network without its five first consensus nodes; the eigenvector has no say in a graph without cycles."""
    result = network.resilience(supply(spark, folder), eigenvector=False)
    return rounded(result.withColumn("nodes_removed", F.array_join("nodes_removed", ",")), 6)


@lane_query(
    "lane_density",
    """,
names AS (SELECT src AS node FROM lanes UNION SELECT dst FROM lanes)
SELECT round((SELECT count(*) FROM lanes)::DOUBLE / (count(*) * (count(*) - 1)), 8) AS density FROM names""",
)
def lane_density(edges: DataFrame) -> DataFrame:
    return rounded(network.density(edges), 8)


@lane_query(
    "lane_clustering",
    """,
ways AS (SELECT src AS a, dst AS b FROM lanes UNION SELECT dst, src FROM lanes),
deg AS (SELECT a AS node, count(*) AS degree FROM ways GROUP BY 1),
tri AS (
  SELECT x.a AS node, count(*) // 2 AS triangles
  FROM ways x JOIN ways y ON x.b = y.a JOIN ways z ON y.b = z.a AND z.b = x.a GROUP BY 1
)
SELECT node, degree, coalesce(triangles, 0) AS triangles,
       round(coalesce(2 * triangles / nullif(degree * (degree - 1), 0)::DOUBLE, 0), 8) AS clustering
FROM deg LEFT JOIN tri USING (node)""",
)
def lane_clustering(edges: DataFrame) -> DataFrame:
    return rounded(network.clustering(edges), 8)
