"""Network metrics over edge DataFrames ``(src, dst, weight, ...)``.

Graphs never come to the driver: every step is a join and an aggregation, and
each round of an iteration is stored before the next one starts. Paths are
counted in hops. Nodes are those of the edges unless a ``nodes`` frame adds
isolated ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.durable import durable, removed, scratch_path, stored_at, without_old_shuffles
from wharfline.functions.expressions import ratio
from wharfline.functions.unions import link
from wharfline.operators.aggregates import edge_weights, top_n_per_group

# States of path searches kept at a time, as (source, node) pairs.
PAIRS_PER_ROUND = 200_000_000
# Rows of one shuffled partition where partitions follow the size of a graph.
ROWS_PER_TASK = 1_000_000
# Edges of a task that are contracted together.
EDGES_AT_ONCE = 1_000_000
# Steps in which the pairs of a search are bounded before it is cut into rounds.
BOUND_ROUNDS = 32


# ------------------------------------------------------------------ edges


def build_edges(
    df: DataFrame,
    source: str,
    target: str,
    weight: str | None = None,
    attributes: Sequence[str] = (),
    order: Sequence[str] = (),
    directed: bool = True,
) -> DataFrame:
    """One edge per pair; a repeated pair keeps the attributes of its last row by ``order``.

    Without direction the smaller node comes first.
    """
    a, b = F.col(source), F.col(target)
    kept = [*([F.col(weight).alias("weight")] if weight else []), *[F.col(c) for c in attributes]]
    pair = df.dropna(subset=[source, target]).select(
        (a if directed else F.least(a, b)).alias("src"),
        (b if directed else F.greatest(a, b)).alias("dst"),
        F.struct(*kept, F.lit(1).alias("_one")).alias("_kept"),
        F.struct(*[F.col(c) for c in order], F.lit(1).alias("_one")).alias("_order"),
    )
    last = pair.groupBy("src", "dst").agg(F.max_by("_kept", F.struct("_order", "_kept")).alias("_kept"))
    return last.select("src", "dst", "_kept.*").drop("_one")


def node_set(edges: DataFrame) -> DataFrame:
    """Every node that is an end of an edge."""
    return edges.select("src").union(edges.select("dst")).distinct().withColumnRenamed("src", "node")


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, once."""
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select(F.inline(ends)).distinct()


def relative_width(edges: DataFrame, factor: float = 3.0) -> DataFrame:
    """Edge width: the weight's share of the largest weight, times a factor."""
    return edges.withColumn("width", ratio(F.col("weight") * factor, edges.agg(F.max("weight")).scalar()))


# ---------------------------------------------------------------- degrees


def degrees(edges: DataFrame) -> DataFrame:
    """In, out, total and weighted degree per node, from one pass over the edges."""
    w = F.col("weight").cast("double") if "weight" in edges.columns else F.lit(1.0)
    none, zero = F.lit(0), F.lit(0.0)
    out_end = F.struct(F.col("src").alias("node"), none.alias("i"), F.lit(1).alias("o"), zero.alias("wi"), w.alias("wo"))
    in_end = F.struct(F.col("dst").alias("node"), F.lit(1).alias("i"), none.alias("o"), w.alias("wi"), zero.alias("wo"))
    return (
        edges.select(F.inline(F.array(out_end, in_end)))
        .groupBy("node")
        .agg(
            F.sum("i").alias("in_degree"),
            F.sum("o").alias("out_degree"),
            F.sum(F.col("i") + F.col("o")).alias("degree"),
            F.sum("wi").alias("weighted_in"),
            F.sum("wo").alias("weighted_out"),
        )
    )


def degree_centrality(edges: DataFrame, directed: bool = True) -> DataFrame:
    """Degrees divided by the number of other nodes; 1 in a graph of one node."""
    counted = degrees(edges)
    others = counted.agg(F.count(F.lit(1))).scalar() - 1

    def share(column: str) -> Column:
        return F.when(others > 0, F.col(column) / others).otherwise(F.lit(1.0))

    names = {"degree_centrality": share("degree")}
    if directed:
        names |= {"in_degree_centrality": share("in_degree"), "out_degree_centrality": share("out_degree")}
    return counted.select("node", *[c.alias(n) for n, c in names.items()])


# ------------------------------------------------------------------ paths


@contextmanager
def fixed_partitions(spark: SparkSession) -> Iterator[None]:
    """Plans made inside keep the number of shuffle partitions, so that stored frames stay placed by their keys.

    Adaptive plans coalesce partitions frame by frame, and what they store has no
    known placement: every later join would shuffle it again.
    """
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def _placed(df: DataFrame, *keys: str) -> DataFrame:
    """Stored rows, placed by hash of the keys."""
    return durable(df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys))


def _hops(edges: DataFrame, directed: bool) -> DataFrame:
    """Stored steps of a search, placed by their start."""
    steps = edges.select("src", "dst").distinct() if directed else both_ways(edges)
    with fixed_partitions(edges.sparkSession):
        return _placed(steps.where(F.col("src") != F.col("dst")), "src")


def _search(hops: DataFrame, sources: DataFrame) -> list[DataFrame]:
    """Nodes reached from every source, level by level: (source, node, dist, paths).

    Levels stay placed by (source, node), and their union with them, so a level
    shuffles its frontier along the steps and what that reaches, never the pairs
    that were reached before.
    """
    start = sources.select(
        F.col("node").alias("source"), "node", F.lit(0).alias("dist"), F.lit(1.0).alias("paths")
    )
    with fixed_partitions(hops.sparkSession):
        levels = [_placed(start, "source", "node")]
        seen = levels[0].select("source", "node")
        while True:
            ahead = (
                levels[-1]
                .join(hops.hint("merge"), F.col("node") == F.col("src"))
                .groupBy("source", F.col("dst").alias("node"))
                .agg(F.sum("paths").alias("paths"))
                .join(seen.hint("merge"), ["source", "node"], "left_anti")
                .select("source", "node", F.lit(len(levels)).alias("dist"), "paths")
            )
            reached = durable(ahead)
            if reached.isEmpty():
                return levels
            levels.append(reached)
            seen = seen.union(reached.select("source", "node"))


def _dependencies(hops: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Share of shortest paths from each source that run through each node, from the far end back."""
    with fixed_partitions(hops.sparkSession):
        return _passed_back(hops, levels)


def _passed_back(hops: DataFrame, levels: list[DataFrame]) -> DataFrame:
    below = levels[-1].select("source", "node", "paths", F.lit(0.0).alias("delta"))
    parts = [below]
    for level in reversed(levels[1:-1]):
        share = below.select("source", F.col("node").alias("dst"), ((F.col("delta") + 1) / F.col("paths")).alias("_share"))
        # A level goes along its steps, as in the search; backwards, a hub far down would meet all its predecessors for every source.
        passed = (
            level.select("source", F.col("node").alias("src"), "paths")
            .join(hops, "src")
            .join(share, ["source", "dst"])
            .groupBy("source", F.col("src").alias("node"))
            .agg(F.sum(F.col("_share") * F.col("paths")).alias("delta"))
        )
        here = level.select("source", "node", "paths").join(passed, ["source", "node"], "left")
        below = durable(here.withColumn("delta", F.coalesce("delta", F.lit(0.0))))
        parts.append(below)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _pair_bound(hops: DataFrame, everyone: DataFrame, sources: DataFrame, n: int) -> int:
    """At least as many (source, node) pairs as a search reaches: walks from every source, and all nodes where those are more.

    Walks are counted a step further per round; a node whose count still grows
    after ``BOUND_ROUNDS`` is on or before a cycle or a long path, and counts as reaching everything.
    """
    with fixed_partitions(hops.sparkSession):
        reach = _placed(everyone.select("node", F.lit(1.0).alias("walks"), F.lit(True).alias("grows")), "node")
        for _ in range(BOUND_ROUNDS):
            ahead = (
                hops.join(reach.select(F.col("node").alias("dst"), "walks"), "dst")
                .groupBy(F.col("src").alias("node"))
                .agg(F.sum("walks").alias("_ahead"))
            )
            walks = F.least(F.coalesce("_ahead", F.lit(0.0)) + 1, F.lit(float(n)))
            reach = durable(reach.join(ahead, "node", "left").select("node", walks.alias("walks"), (walks > F.col("walks")).alias("grows")))
            if reach.where("grows").isEmpty():
                break
        bound = F.when(F.col("grows"), F.lit(float(n))).otherwise(F.col("walks"))
        return int(sources.join(reach, "node").agg(F.coalesce(F.sum(bound), F.lit(0.0))).first()[0])


def path_metrics(
    edges: DataFrame,
    directed: bool = True,
    nodes: DataFrame | None = None,
    sample: DataFrame | None = None,
    pairs_per_round: int = PAIRS_PER_ROUND,
) -> DataFrame:
    """Betweenness and closeness of every node, and the sum and number of path lengths into it.

    Betweenness is normalised; closeness uses the distances into a node and is
    scaled by the share of nodes that reach it. The search starts from all
    nodes, in rounds that hold at most about ``pairs_per_round`` reached pairs, so the
    work is that of the pairs within reach and nodes times edges at most; ``sample``
    restricts it to given sources, which then only estimates both metrics.
    """
    everyone = durable(nodes if nodes is not None else node_set(edges))
    n = everyone.count()
    hops = _hops(edges, directed)
    sources = sample if sample is not None else everyone
    most = n * sources.count()
    if most > pairs_per_round:  # all pairs are too many, but few of them may be reached
        most = _pair_bound(hops, everyone, sources, n)
    rounds = max(1, math.ceil(most / pairs_per_round))
    totals = None
    for i in range(rounds):
        mine = sources if rounds == 1 else sources.where(F.pmod(F.xxhash64("node"), F.lit(rounds)) == i)
        levels = _search(hops, mine)
        reached = levels[0]
        for level in levels[1:]:
            reached = reached.union(level)
        into = reached.groupBy("node").agg(F.sum("dist").alias("_dist"), F.count(F.lit(1)).alias("_n"))
        if len(levels) > 1:
            through = _dependencies(hops, levels).groupBy("node").agg(F.sum("delta").alias("_delta"))
            into = into.join(through, "node", "left")
        else:
            into = into.withColumn("_delta", F.lit(0.0))
        totals = into if totals is None else durable(totals.union(into))
    summed = totals.groupBy("node").agg(F.sum("_dist").alias("_dist"), F.sum("_n").alias("_n"), F.sum("_delta").alias("_delta"))
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    # Without sampling every node reaches itself, so it is among those counted.
    arriving = F.coalesce("_n", F.lit(0)) - (1 if sample is None else 0)
    close = ratio(arriving, F.col("_dist")) * ratio(arriving, F.lit(n - 1))
    return everyone.join(summed, "node", "left").select(
        "node",
        (F.coalesce("_delta", F.lit(0.0)) * scale).alias("betweenness"),
        F.coalesce(close, F.lit(0.0)).alias("closeness"),
        F.coalesce("_dist", F.lit(0)).alias("distance_sum"),
        arriving.alias("reached_from"),
    )


def average_path_length(metrics: DataFrame) -> DataFrame:
    """Mean distance over all ordered pairs, NULL unless every node reaches every other; from path metrics."""
    n, pairs = F.count(F.lit(1)), F.sum("reached_from")
    complete = pairs == n * (n - 1)
    return metrics.agg(
        F.coalesce(complete, F.lit(False)).alias("strongly_connected"),
        F.when(complete, ratio(F.sum("distance_sum"), pairs)).alias("average_path_length"),
    )


# ------------------------------------------------------------- components


@contextmanager
def sized_partitions(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans run inside shuffle at most about ``ROWS_PER_TASK`` rows to a task, and split what a hub brings beyond that.

    With a fixed number of partitions the memory of a task would grow with the table.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def contracted(pairs: DataFrame) -> DataFrame:
    """The same components from fewer pairs (u, v): in every task, ``EDGES_AT_ONCE`` pairs at a time become stars.

    A star has a pair less than nodes, so there are never more pairs than before.
    """

    def stars(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        n, ends = rows.num_rows, pa.chunked_array(rows.column("u").chunks + rows.column("v").chunks)
        coded = ends.combine_chunks().dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[coded.indices.to_numpy()]
        first = link(np.arange(len(order)), at[:n], at[n:])
        some = np.flatnonzero(first != np.arange(len(order)))
        names = coded.dictionary.take(pa.array(order))
        yield from pa.table({"u": names.take(pa.array(some)), "v": names.take(pa.array(first[some]))}).to_batches()

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= EDGES_AT_ONCE:
                yield from stars(waiting)
                waiting = []
        if waiting:
            yield from stars(waiting)

    return pairs.mapInArrow(contract, pairs.schema)


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Weakly connected component of every node, named by its smallest node.

    Alternates two star operations: attach a node's larger neighbours to its
    smallest one, then the smaller ones. The number of rounds grows with the
    logarithm of the graph, and minima are combined map-side, hubs included.
    Edges are contracted where they lie before any is shuffled, and only the pairs of the
    last round are kept.
    """
    spark = edges.sparkSession

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        ends = pairs.union(pairs.select("v", "u")) if large else pairs.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
        ends = ends.toDF("u", "v")
        lowest = ends.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
        joined = ends.join(lowest, F.col("u") == F.col("_u"))
        if large:
            return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        to_lowest = joined.select(F.col("v").alias("u"), F.col("_m").alias("v"))
        itself = lowest.select(F.col("_u").alias("u"), F.col("_m").alias("v"))
        return to_lowest.union(itself).where(F.col("u") != F.col("v")).distinct()

    with sized_partitions(spark, 2 * edges.count()), without_old_shuffles(spark):
        path = scratch_path(spark, "pairs")
        pairs = stored_at(contracted(edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u <> v")).distinct(), path)
        mark = None
        while True:
            before, path = path, scratch_path(spark, "pairs")
            pairs = stored_at(star(star(pairs, True), False), path)
            removed(spark, before)
            found = pairs.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
            ).first()
            if tuple(found) == mark:
                break
            mark = tuple(found)
        everyone = nodes if nodes is not None else node_set(edges)
        label = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        named = durable(everyone.join(label, "node", "left").withColumn("component", F.coalesce("component", "node")))
        removed(spark, path)
        return named


# ------------------------------------------------------------ eigenvector


def eigenvector_centrality(
    edges: DataFrame, directed: bool = True, max_iter: int = 1000, tolerance: float = 1e-6, steps: int = 4
) -> DataFrame:
    """Power iteration of the incoming adjacency plus the identity: (node, eigenvector, converged).

    Stops when the vector changes by less than nodes times tolerance, or marks
    the result as not converged. ``steps`` iterations run per stored round.
    """
    hops = durable((edges.select("src", "dst").distinct() if directed else both_ways(edges)).repartition("src"))
    everyone = node_set(edges)
    vector = durable(everyone.withColumn("x", F.lit(1.0)))
    n = vector.count()
    done, used = n == 0, 0
    while not done and used < max_iter:
        todo = min(steps, max_iter - used)
        current, before = vector.select("node", "x"), None
        for _ in range(todo):
            before = current
            moved = before.join(hops, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), "x")
            current = before.select("node", "x").union(moved).groupBy("node").agg(F.sum("x").alias("x"))
        pair = durable(current.join(before.select("node", F.col("x").alias("_old")), "node"))
        norms = pair.agg(F.sqrt(F.sum(F.col("x") * F.col("x"))), F.sqrt(F.sum(F.col("_old") * F.col("_old")))).first()
        scaled = pair.select("node", (F.col("x") / norms[0]).alias("x"), (F.col("_old") / norms[1]).alias("_old"))
        change = scaled.agg(F.sum(F.abs(F.col("x") - F.col("_old")))).first()[0]
        vector, used = scaled.select("node", "x"), used + todo
        done = change < n * tolerance
    return vector.select("node", F.col("x").alias("eigenvector"), F.lit(bool(done)).alias("converged"))


# ------------------------------------------------------------ communities


def _modularity(weights: DataFrame, labels: DataFrame, total: float, resolution: float) -> float:
    """Modularity of a labelling over symmetric weights (each edge both ways, loops twice)."""
    a = labels.select(F.col("node").alias("src"), F.col("community").alias("_a"))
    b = labels.select(F.col("node").alias("dst"), F.col("community").alias("_b"))
    tagged = weights.join(a, "src").join(b, "dst")
    sums = tagged.groupBy("_a").agg(
        F.sum(F.when(F.col("_a") == F.col("_b"), F.col("weight")).otherwise(0.0)).alias("_in"),
        F.sum("weight").alias("_all"),
    )
    q = sums.agg(F.sum(F.col("_in") / total - resolution * F.pow(F.col("_all") / total, F.lit(2.0)))).first()[0]
    return q or 0.0


def _improve(weights: DataFrame, resolution: float, total: float) -> tuple[DataFrame, float]:
    """Move nodes to the neighbouring community with the largest gain, half of them per round.

    Ends when two rounds in a row, which give every node its turn, bring no gain.
    """
    strength = durable(weights.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k")))
    labels = durable(strength.select("node", F.col("node").alias("community")))
    best, idle = _modularity(weights, labels, total, resolution), 0
    for i in count():
        own = labels.join(strength, "node")
        sizes = own.groupBy("community").agg(F.sum("k").alias("size"))
        links = (
            weights.where(F.col("src") != F.col("dst"))
            .join(labels.withColumnRenamed("node", "dst"), "dst")
            .groupBy(F.col("src").alias("node"), "community")
            .agg(F.sum("weight").alias("link"))
        )
        # Staying is always a choice, also without links inside the own community.
        stay = own.select("node", "community", F.lit(0.0).alias("link"))
        choice = links.union(stay).groupBy("node", "community").agg(F.sum("link").alias("link"))
        scored = choice.join(sizes, "community").join(own.withColumnRenamed("community", "_own"), "node")
        rest = F.col("size") - F.when(F.col("community") == F.col("_own"), F.col("k")).otherwise(0.0)
        gain = F.col("link") - F.col("k") * rest * (resolution / total)
        stays = (F.col("community") == F.col("_own")).cast("int")
        picked = scored.groupBy("node", "_own").agg(
            F.max_by("community", F.struct(F.round(gain, 9), stays, F.col("community"))).alias("_new")
        )
        turn = F.pmod(F.xxhash64("node") + i, F.lit(2)) == 0
        moved = durable(picked.select("node", F.when(turn, F.col("_new")).otherwise(F.col("_own")).alias("community")))
        score = _modularity(weights, moved, total, resolution)
        if score > best + 1e-9:
            labels, best, idle = moved, score, 0
        else:
            idle += 1
            if idle == 2:
                break
    return labels, best


def communities(edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """Community of every node of the undirected graph: (node, community, modularity).

    Nodes move by modularity gain, then each community becomes one node, until
    modularity stops growing. The partition can differ from that of a
    sequential optimiser; its modularity is never below that of single nodes.
    """
    w = F.col("weight").cast("double") if "weight" in edges.columns else F.lit(1.0)
    once = edges.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max(w).alias("weight"))
    ends = F.array(
        F.struct("src", "dst", "weight"),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"),
    )
    weights = durable(once.select(F.inline(ends)))
    total = weights.agg(F.sum("weight")).first()[0] or 0.0
    assigned, best = None, None
    while total:
        labels, score = _improve(weights, resolution, total)
        if best is not None and score <= best + 1e-9:
            break
        best = score
        if assigned is None:
            assigned = labels
        else:
            step = labels.select(F.col("node").alias("community"), F.col("community").alias("_c"))
            assigned = durable(assigned.join(step, "community").select("node", F.col("_c").alias("community")))
        a = labels.select(F.col("node").alias("src"), F.col("community").alias("_a"))
        b = labels.select(F.col("node").alias("dst"), F.col("community").alias("_b"))
        merged = weights.join(a, "src").join(b, "dst").groupBy(F.col("_a").alias("src"), F.col("_b").alias("dst"))
        weights = durable(merged.agg(F.sum("weight").alias("weight")))
    if assigned is None:
        assigned = node_set(edges).withColumn("community", F.col("node"))
    return assigned.withColumn("modularity", F.lit(best))


def community_sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("community").agg(F.count(F.lit(1)).alias("nodes"))


# ------------------------------------------------- critical nodes, resilience


def centrality_metrics(
    edges: DataFrame, directed: bool = True, eigenvector: bool = True, max_iter: int = 1000, paths: DataFrame | None = None
) -> DataFrame:
    """All centralities in long form: (metric, node, score).

    The eigenvector is left out for a graph in several parts.
    """
    degree = degree_centrality(edges, directed)
    paths = path_metrics(edges, directed) if paths is None else paths
    wide = degree.join(
        paths.select(
            "node", F.col("betweenness").alias("betweenness_centrality"), F.col("closeness").alias("closeness_centrality")
        ),
        "node",
    )
    if eigenvector and components(edges).select("component").distinct().count() == 1:
        values = eigenvector_centrality(edges, directed, max_iter)
        wide = wide.join(values.select("node", F.col("eigenvector").alias("eigenvector_centrality")), "node")
    metrics = [c for c in wide.columns if c != "node"]
    return wide.unpivot(["node"], metrics, "metric", "score")


def critical_nodes(metrics: DataFrame, top_n: int = 10) -> DataFrame:
    """The ``top_n`` nodes of every metric; equal scores go by node."""
    order = [F.desc(F.round("score", 12)), F.asc("node")]
    return top_n_per_group(metrics, ["metric"], order, top_n)


def consensus_nodes(critical: DataFrame) -> DataFrame:
    """Nodes critical by at least two metrics, with the share of metrics naming them."""
    metrics = critical.agg(F.count_distinct("metric")).scalar()
    votes = critical.groupBy("node").agg(F.count(F.lit(1)).alias("votes"))
    return votes.where(F.col("votes") > 1).select("node", "votes", (F.col("votes") / metrics).alias("score"))


def first_consensus(consensus: DataFrame, n: int = 5) -> DataFrame:
    return consensus.orderBy(F.desc("votes"), "node").limit(n)


def _properties(edges: DataFrame, nodes: DataFrame, directed: bool, paths: DataFrame | None = None) -> DataFrame:
    paths = path_metrics(edges, directed, nodes) if paths is None else paths
    return average_path_length(paths).select(
        nodes.agg(F.count(F.lit(1))).scalar().alias("nodes"),
        edges.agg(F.count(F.lit(1))).scalar().alias("edges"),
        components(edges, nodes).agg(F.count_distinct("component")).scalar().alias("components"),
        "average_path_length",
    )


def resilience(
    edges: DataFrame, directed: bool = True, top_n: int = 10, remove: int = 5, removed: DataFrame | None = None,
    eigenvector: bool = True, max_iter: int = 1000,
) -> DataFrame:
    """What taking out the first consensus nodes does to the network; one row.

    Path lengths are NULL where some node cannot reach another.
    """
    edges = durable(edges.select("src", "dst").distinct())
    nodes = durable(node_set(edges))
    paths = durable(path_metrics(edges, directed, nodes))
    if removed is None:
        metrics = centrality_metrics(edges, directed, eigenvector, max_iter, paths)
        removed = first_consensus(consensus_nodes(critical_nodes(metrics, top_n)), remove)
    gone = durable(removed.select("node"))
    left_nodes = durable(nodes.join(gone, "node", "left_anti"))
    left_edges = durable(
        edges.join(gone.withColumnRenamed("node", "src"), "src", "left_anti")
        .join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
        .select("src", "dst")
    )
    before = _properties(edges, nodes, directed, paths).toDF("nodes", "edges", "components", "average_path_length")
    after = _properties(left_edges, left_nodes, directed).select(F.struct("*")).scalar()
    names = gone.agg(F.array_sort(F.collect_list("node"))).scalar()
    return before.select(
        "nodes",
        "edges",
        "components",
        "average_path_length",
        after.getField("average_path_length").alias("average_path_length_after"),
        (ratio(F.col("nodes") - after.getField("nodes"), F.col("nodes")) * 100).alias("node_loss_percentage"),
        (ratio(F.col("edges") - after.getField("edges"), F.col("edges")) * 100).alias("edge_loss_percentage"),
        (after.getField("components") - F.col("components")).alias("fragmentation_increase"),
        names.alias("nodes_removed"),
    )


def network_features(df: DataFrame, source: str, target: str, value: str | None = None) -> DataFrame:
    """Degree, betweenness, closeness and weighted degree of both ends, joined to every row."""
    edges = durable(edge_weights(df, source, target, value))
    features = durable(degrees(edges).join(path_metrics(edges), "node"))
    weighted = value is not None

    def side(column: str, way: str) -> DataFrame:
        return features.select(
            F.col("node").alias(column),
            F.col(f"{way}_degree").alias(f"{column}_{way}_degree"),
            F.col("betweenness").alias(f"{column}_betweenness"),
            F.col("closeness").alias(f"{column}_closeness"),
            *([F.col(f"weighted_{way}").alias(f"{column}_weighted_{way}")] if weighted else []),
        )

    return df.join(side(source, "out"), source, "left").join(side(target, "in"), target, "left")


# ------------------------------------------------------ density, clustering


def density(edges: DataFrame, directed: bool = True) -> DataFrame:
    """Share of possible edges that exist; 0 in a graph of one node."""
    n = node_set(edges).agg(F.count(F.lit(1))).scalar().cast("double")
    m = F.count(F.lit(1)) * (1 if directed else 2)
    pairs = n * (n - 1)
    return edges.select("src", "dst").distinct().agg(m.alias("_m")).select(
        F.coalesce(ratio(F.col("_m"), pairs), F.lit(0.0)).alias("density")
    )


def clustering(edges: DataFrame) -> DataFrame:
    """Share of a node's neighbour pairs that are neighbours themselves: (node, degree, triangles, clustering).

    Edges point from the node with fewer neighbours to the one with more, so a
    hub starts few of the two-edge paths that are tried.
    """
    ways = durable(both_ways(edges.where(F.col("src") != F.col("dst"))))
    degree = durable(ways.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree")))
    a = degree.select(F.col("node").alias("src"), F.col("degree").alias("_a"))
    b = degree.select(F.col("node").alias("dst"), F.col("degree").alias("_b"))
    upward = durable(
        ways.join(a, "src").join(b, "dst").where(F.struct("_a", "src") < F.struct("_b", "dst")).select("src", "dst")
    )
    first = upward.toDF("x", "y")
    paths = first.join(upward.toDF("y", "z"), "y")
    closed = paths.join(upward.toDF("x", "z"), ["x", "z"])
    corners = closed.select(F.explode(F.array("x", "y", "z")).alias("node")).groupBy("node").agg(
        F.count(F.lit(1)).alias("triangles")
    )
    joined = node_set(edges).join(degree, "node", "left").join(corners, "node", "left").na.fill(0, ["degree", "triangles"])
    pairs = F.col("degree") * (F.col("degree") - 1)
    return joined.withColumn("clustering", F.coalesce(ratio(F.col("triangles") * 2, pairs), F.lit(0.0)))
