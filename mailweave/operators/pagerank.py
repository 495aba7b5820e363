"""PageRank as one keyed DataFrame operator.

The same loop ranks one graph, a weighted graph, or every slice of a sliced
graph at once (``by``), each slice with its own node count and dangling mass:

    new(v) = (1 - d) / n + d * dangling / n + d * sum(rank(u) * w(u, v) / w(u, *))

Layout, chosen so that the edges are shuffled once and not per iteration:

* `pagerank` ranks numbers: every (slice, id) has one of 64 bits, and the ids
  come back with the last ranks. The numbers are hashes, so that no edge is
  joined to get them, and are drawn anew if two nodes share one. Without slices,
  ids that are numbers already (`number_nodes`) stay as they are;
* `pageranks` ranks several graphs of the same pairs in one loop: an edge has a
  weight and a node a rank for each of them;
* where most nodes send to nobody, all iterations but the last keep the ranks of
  the others only: what the silent nodes hold follows from what is sent to them,
  and their own ranks are worked out in the last iteration;
* the edges are hash-partitioned and sorted on (slice, source, part) and cached;
  each iteration merges the ranks into them, so what moves is one row per node,
  not one per edge;
* a source with more edges than an average task holds is cut into parts by
  target, and its rank is sent to each part;
* in a dense graph without such sources the edges are dealt to a grid of cells by
  source and target instead: a rank is sent to every column, and a target costs
  one row per row of the grid, where it cost nearly one per edge;
* contributions are summed per task before they are shuffled on the target, so
  a target with very many sources costs one row per task;
* the nodes are cached in the partitioning in which the sums arrive;
* the ranks are cached after every iteration and written as a table after some:
  the plan stays short, and a lost executor costs its cached blocks and at most
  the iterations since the last table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.operators.graph import node_strength, node_strengths, nodes as node_set
from mailweave.session import as_table, drop_table, setting, shared_folder

# A source is never cut for fewer edges than this.
MIN_PART_EDGES = 1_000_000

# With fewer edges per shuffle partition than this, the edges are not placed:
# adaptive execution then merges the small shuffles into few tasks.
MIN_TASK_EDGES = 5_000

# Rows that a task of the loop gets before there are as many as shuffle partitions.
TASK_ROWS = 250_000

# Up to this many slices or large sources are broadcast (about 100 bytes each).
MAX_BROADCAST_ROWS = 100_000

# Parts per slice where there are more slices than that.
SLICE_PARTS = 32

# Edges that are placed by their cell are joined on cell and source where they are.
PLACED_SETTING = "spark.sql.requireAllClusterKeysForCoPartition"

# The loop shuffles into as many partitions as it has placed edges and nodes in.
PARTITIONS_SETTING = "spark.sql.shuffle.partitions"

# Edges of a cell of the grid (about 100 MB cached), and its least cells per core.
CELL_EDGES, CORE_CELLS = 4_000_000, 2

# Silent nodes are set apart where there are this many nodes per sender.
NODES_PER_SENDER = 2


class RankState(NamedTuple):
    """A graph prepared for the loop, and the ranks reached so far."""

    edges: DataFrame  # slice…, src, part, dst, w
    nodes: DataFrame  # slice…, id, out_weight, parts
    ranks: DataFrame  # the nodes with their rank
    keys: list[str]  # the slice columns, none for one graph
    slices: int
    on: list[str]  # the slice columns that an id needs to name a node
    grid: tuple[int, int] | None = None  # rows and columns of cells, if edges have a cell
    labels: Sequence[int] = ()  # by which the cells go to partitions
    tags: Sequence[str] = ("",)  # endings of w, out_weight and rank, one per ranked graph
    partitions: int | None = None  # of placed edges and nodes
    every: DataFrame | None = None  # with silent nodes apart: their edges too
    sizes: DataFrame | None = None  # and slice…, n, silent
    tables: Sequence[DataFrame] = ()  # to drop when all is done

    def release(self) -> None:
        """Drop the cached graph; written ranks stay readable."""
        self.edges.unpersist()
        self.nodes.unpersist()


def _cached(df: DataFrame, keys: Sequence[str], partitions: int | None) -> DataFrame:
    """Cache ``df``, hash-partitioned and sorted on the keys if a number is given.

    With the number of partitions that joins and aggregations use, neither has
    to move the rows again.
    """
    if partitions:
        df = df.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def start_ranks(
    graph: DataFrame,
    weight: str | None = None,
    by: Sequence[str] = (),
    part_edges: int | None = None,
) -> RankState:
    """Place the graph for the loop and give every node rank ``1 / n``.

    A source gets one part per ``part_edges`` edges; the default is the average
    number of edges per shuffle partition.
    """
    shared_folder(graph.sparkSession)
    keys = list(by)
    edges = _weighted(graph, weight, keys).checkpoint()
    strength = node_strength(edges, keys, weight and "w").checkpoint()
    return _placed(edges, strength, keys, keys, part_edges)


def _weighted(graph: DataFrame, weight: str | None, keys: Sequence[str]) -> DataFrame:
    """The edges, with a column ``w`` unless each weighs 1."""
    w = [F.col(weight).cast("double").alias("w")] if weight else []
    return graph.select(*keys, "src", "dst", *w)


def _weights(edges: DataFrame, tags: Sequence[str]) -> list[str]:
    return [f"w{tag}" for tag in tags if f"w{tag}" in edges.columns]


def _sending(edges: DataFrame, tags: Sequence[str]) -> DataFrame:
    """The edges that weigh something in one of the graphs."""
    weights = _weights(edges, tags)
    if len(weights) < len(tags):
        return edges
    return edges.where(reduce(Column.__or__, [F.col(w) > 0 for w in weights]))


def _grid(edges: int, nodes: int, senders: int, partitions: int, cells: int) -> tuple[int, int] | None:
    """Rows and columns of the grid that moves the fewest rows per iteration, None if that
    is over half of what moves with all edges of a source in one of the partitions."""

    def moved(rows: int, columns: int) -> float:
        targets = nodes * rows
        return senders * columns - targets * math.expm1(-edges / targets)

    shapes = [(-(-cells // columns), columns) for columns in range(1, cells + 1)]
    best = min(shapes, key=lambda shape: moved(*shape))
    return best if 2 * moved(*best) < moved(partitions, 1) else None


def _row(node: str, rows: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(rows))


def _labels(spark: SparkSession, count: int) -> list[int]:
    """A number for each of ``count`` cells, of which hash partitioning puts one in each partition."""
    found: dict[int, int] = {}
    for first in itertools.count(0, 32 * count):
        label = F.col("id").cast("int")
        tried = spark.range(first, first + 32 * count).select(F.pmod(F.hash(label), F.lit(count)), label)
        for partition, number in tried.collect():
            found.setdefault(partition, number)
        if len(found) == count:
            return list(found.values())


def _labelled(cell: Column, labels: Sequence[int]) -> Column:
    return F.get(F.array(*map(F.lit, labels)), cell.cast("int")).alias("cell")


def _placed(
    edges: DataFrame,
    strength: DataFrame,
    keys: list[str],
    on: list[str],
    part_edges: int | None,
    cells: int = 0,
    tags: Sequence[str] = ("",),
) -> RankState:
    """The state before the first iteration, from tables of edges and of their nodes; with
    ``cells`` per core, the edges may be placed in a grid or the silent nodes set apart."""
    spark = edges.sparkSession
    sizes = strength.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("out_degree").alias("edges"),
        F.count_if(F.col("out_degree") > 0).alias("senders"),
        F.max("out_degree").alias("largest"),
        F.count_if(~(F.col(f"out_weight{tags[0]}") > 0)).alias("silent"),
    )
    counts = ("edges", "n", "senders", "largest")
    slices, total, number, senders, largest = sizes.agg(
        F.count("*"), *(F.coalesce((F.max if c == "largest" else F.sum)(c), F.lit(0)) for c in counts)
    ).first()
    count = int(spark.conf.get(PARTITIONS_SETTING))
    partitions = count if total // count >= MIN_TASK_EDGES else None
    if part_edges is None:
        part_edges = max(total // count, MIN_PART_EDGES)
    grid = None
    if cells and partitions and largest <= part_edges:
        cells = max(total // CELL_EDGES, cells * spark.sparkContext.defaultParallelism)
        grid = _grid(total, number, senders, count, cells)
    if cells and partitions:
        moved = number * grid[0] if grid else total
        partitions = min(count, max(moved // TASK_ROWS, spark.sparkContext.defaultParallelism))
    parts = F.greatest(F.ceil(F.col("out_degree") / part_edges), F.lit(1)).cast("int")
    nodes = strength.select(*keys, "id", *[f"out_weight{tag}" for tag in tags], parts.alias("parts"))
    sending, weights = _sending(edges, tags), _weights(edges, tags)
    apart = bool(cells and not grid and len(tags) == 1 and 0 < NODES_PER_SENDER * senders <= number)
    if not apart:
        nodes = _cached(nodes, [*on, "id"], partitions)
        start = sizes.select(*keys, F.struct((1.0 / F.col("n")).alias("rank")).alias("start"))
        ranks = _with_slice(nodes, start, keys, slices)
        ranks = ranks.select(*nodes.columns, *[F.col("start.rank").alias(f"rank{tag}") for tag in tags])
    if grid:
        rows, columns = grid
        labels = _labels(spark, rows * columns)
        cell = _row("src", rows) * columns + F.pmod(F.xxhash64("dst"), F.lit(columns))
        split = sending.select(*on, "src", _labelled(cell, labels), "dst", *weights)
        split = split.repartition(rows * columns, "cell").sortWithinPartitions("cell", *on, "src")
        split = split.persist(StorageLevel.MEMORY_AND_DISK)
        split.count()  # plans know where cached rows are, and keep these few partitions, once they are there
        return RankState(split, nodes, ranks, keys, slices, on, grid, labels, tags, partitions)

    # Each large source holds more than part_edges of the total, so there are
    # fewer than total / part_edges of them: by default at most one per task.
    large = nodes.where(F.col("parts") > 1).select(*on, F.col("id").alias("src"), "parts")
    if total // part_edges <= max(count, MAX_BROADCAST_ROWS):
        large = F.broadcast(large)
    part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("parts")), F.lit(0)).cast("int")

    def in_parts(df: DataFrame) -> DataFrame:
        return df.join(large, [*on, "src"], "left").select(*on, "src", part.alias("part"), "dst", *weights)

    if not apart:
        split = _cached(in_parts(sending), [*on, "src", "part"], partitions)
        return RankState(split, nodes, ranks, keys, slices, on, None, (), tags, partitions)

    heard = nodes.where(F.coalesce(F.col("out_weight") > 0, F.lit(True)))
    marks = heard.select(*on, F.col("id").alias("dst"), F.lit(True).alias("heard"))
    marked = sending.join(marks, [*on, "dst"], "left").select(*on, "src", "dst", *weights, "heard")
    marked = as_table(marked, "marked")
    to_silent = marked.where("heard IS NULL AND dst IS NOT NULL")
    w = F.col("w") if weights else F.lit(1.0)
    lost = to_silent.groupBy(*on, F.col("src").alias("id")).agg(F.sum(w).alias("lost"))
    nodes = heard.join(lost, [*on, "id"], "left")
    heard = as_table(nodes.select(*heard.columns, F.coalesce("lost", F.lit(0.0)).alias("lost")), "heard")
    nodes = _cached(heard, [*on, "id"], partitions)
    inner = _cached(in_parts(marked.where("heard")), [*on, "src", "part"], partitions)
    sizes = as_table(sizes.select(*keys, "n", "silent"), "sizes")
    start = F.struct((1.0 / F.col("n")).alias("rank"), (F.col("silent") / F.col("n")).alias("held"))
    ranks = _with_slice(nodes, sizes.select(*keys, start.alias("start")), keys, slices)
    ranks = ranks.select(*nodes.columns, "start.rank", "start.held")
    every, tables = in_parts(marked), (marked, heard, sizes)
    return RankState(inner, nodes, ranks, keys, slices, on, None, (), tags, partitions, every, sizes, tables)


def _with_slice(df: DataFrame, totals: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """Add the last column of ``totals``, one value per slice, to the nodes of ``df``.

    One graph takes it as a scalar subquery, few slices as a broadcast. With
    more, both sides are shuffled on the slice, spread over parts so that one
    very large slice does not end in one task.
    """
    if not keys:
        return df.withColumn(totals.columns[-1], totals.scalar())
    if slices <= MAX_BROADCAST_ROWS:
        return df.join(F.broadcast(totals), keys)
    spread = F.pmod(F.xxhash64("id"), F.lit(SLICE_PARTS))
    copies = totals.select(
        F.explode(F.sequence(F.lit(0), F.lit(SLICE_PARTS - 1))).alias("_spread"), "*"
    )
    spread_nodes = df.withColumn("_spread", spread.cast("int"))
    return spread_nodes.join(copies, [*keys, "_spread"]).drop("_spread")


def _totals(state: RankState, damping: float) -> DataFrame:
    """Per slice, in one column ``total``: the ``base`` that every node gets, and with silent nodes
    apart what those will have ``held`` after the step."""
    if state.sizes is None:
        bases = []
        for tag in state.tags:
            silent = F.when(~(F.col(f"out_weight{tag}") > 0), F.col(f"rank{tag}"))
            held = F.coalesce(F.sum(silent), F.lit(0.0))
            bases.append((((1.0 - damping) + damping * held) / F.count("*")).alias(f"base{tag}"))
        return state.ranks.groupBy(*state.keys).agg(F.struct(*bases).alias("total"))
    sent = F.when(F.col("out_weight") > 0, F.col("rank") / F.col("out_weight") * F.col("lost"))
    sums = state.ranks.groupBy(*state.keys).agg(F.max("held").alias("held"), F.sum(sent).alias("sent"))
    sums = state.sizes.join(sums, state.keys, "left") if state.keys else state.sizes.crossJoin(sums)
    held = F.coalesce("held", F.col("silent") / F.col("n"))
    base = ((1.0 - damping) + damping * held) / F.col("n")
    held = F.col("silent") * base + damping * F.coalesce("sent", F.lit(0.0))
    return sums.select(*state.keys, F.struct(base.alias("base"), held.alias("held")).alias("total"))


def _received(state: RankState, edges: DataFrame) -> DataFrame:
    """What the nodes get over the edges: ``slice…, id, received``."""
    on, tags = state.on, state.tags
    sends = [F.col(f"out_weight{tag}") > 0 for tag in tags]
    shares = [
        F.when(s, F.col(f"rank{tag}") / F.col(f"out_weight{tag}")).alias(f"share{tag}")
        for s, tag in zip(sends, tags, strict=True)
    ]
    ranks = state.ranks.where(reduce(Column.__or__, sends))
    if state.grid:
        rows, columns = state.grid
        first = _row("id", rows) * columns
        cells = F.explode(F.sequence(first, first + columns - 1)).alias("cell")
        shares = ranks.select(*on, F.col("id").alias("src"), cells, *shares)
        shares = shares.withColumn("cell", _labelled(F.col("cell"), state.labels))
        sent = edges.join(shares.repartition(rows * columns, "cell"), ["cell", *on, "src"])
    else:
        parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        shares = ranks.select(*on, F.col("id").alias("src"), parts, *shares)
        sent = edges.join(shares, [*on, "src", "part"])
    weights = _weights(edges, tags)

    def term(tag: str) -> Column:
        share, w = F.col(f"share{tag}"), f"w{tag}"
        return F.when(F.col(w) > 0, share * F.col(w)) if w in weights else share

    sums = [F.sum(term(tag)).alias(f"received{tag}") for tag in tags]
    return sent.groupBy(*on, F.col("dst").alias("id")).agg(*sums)


def _updated(state: RankState, nodes: DataFrame, edges: DataFrame, damping: float) -> DataFrame:
    """``nodes`` with the ranks that they get over the edges in one iteration."""
    received = nodes.join(_received(state, edges), [*state.on, "id"], "left")
    updated = _with_slice(received, _totals(state, damping), state.keys, state.slices)
    ranks = [
        (F.col(f"total.base{tag}") + damping * F.coalesce(f"received{tag}", F.lit(0.0))).alias(f"rank{tag}")
        for tag in state.tags
    ]
    held = [] if state.sizes is None else ["total.held"]
    return updated.select(*nodes.columns, *ranks, *held)


def pagerank_step(state: RankState, damping: float = 0.85) -> RankState:
    """One iteration, as a plan; nothing runs until the ranks are used."""
    return state._replace(ranks=_updated(state, state.nodes, state.edges, damping))


def rank_vector(state: RankState) -> DataFrame:
    """``(by…, id, rank)`` of a state."""
    return state.ranks.select(*state.keys, "id", "rank")


def _number(keys: Sequence[str], node: str, seed: int) -> Column:
    """A number for the node in its slice, null where one of its columns is."""
    known = F.col(node).isNotNull()
    for key in keys:
        known &= F.col(key).isNotNull()
    return F.when(known, F.xxhash64(F.lit(seed), *keys, node))


def _free_seed(nodes: DataFrame, keys: Sequence[str]) -> int:
    """The first seed for which no two of the nodes share a number."""
    for seed in itertools.count():
        numbers = nodes.select(_number(keys, "id", seed).alias("number")).where(F.col("number").isNotNull())
        if not numbers.groupBy("number").count().where(F.col("count") > 1).limit(1).count():
            return seed


def number_nodes(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges with a 64-bit number in place of each id, and the table ``number, id``.

    For jobs that rank the same edges more than once: they move and compare numbers, and the
    ids come back with `with_names`. A null id has no number.
    """
    names = as_table(node_set(edges), "names")
    seed = _free_seed(names, [])
    numbered = edges.withColumns({end: _number([], end, seed) for end in ("src", "dst")})
    return numbered, names.select(_number([], "id", seed).alias("number"), "id")


def with_names(ranks: DataFrame, names: DataFrame) -> DataFrame:
    """The ranks of numbered nodes by id; null where ``names`` has none."""
    named = ranks.withColumnRenamed("id", "number").join(names, "number", "left")
    return named.select(*ranks.columns)


def _merged(graphs: Sequence[tuple[DataFrame, str | None]], keys: list[str], tags: Sequence[str]) -> DataFrame:
    """One table of the edges of graphs that have the same pairs, with a weight column for each
    whose edges do not all weigh 1. Rows of a pair are added up."""
    rows = []
    for number, (graph, weight) in enumerate(graphs):
        own = F.col(weight).cast("double") if weight else F.lit(1.0)
        w = [(own if tag == tags[number] else F.lit(None).cast("double")).alias(f"w{tag}") for tag in tags]
        rows.append(graph.select(*keys, "src", "dst", *w, F.lit(1 << number).alias("graph")))
    sums = [F.sum(f"w{tag}").alias(f"w{tag}") for tag in tags]
    pairs = reduce(DataFrame.unionAll, rows).groupBy(*keys, "src", "dst")
    table = as_table(pairs.agg(*sums, F.bit_or("graph").alias("graph")), "graph")
    weighed = [F.count_if(~F.col(f"w{tag}").eqNullSafe(1.0)) for tag in tags]
    apart, *weighed = table.agg(F.count_if(F.col("graph") != (1 << len(tags)) - 1), *weighed).first()
    if apart:
        raise ValueError(f"{apart} pairs are not in every graph")
    return table.drop("graph", *[f"w{tag}" for tag, times in zip(tags, weighed, strict=True) if not times])


def pageranks(
    graphs: Mapping[str, tuple[DataFrame, str | None]],
    by: Sequence[str] = (),
    damping: float = 0.85,
    iterations: int = 10,
    part_edges: int | None = None,
    checkpoint_every: int = 5,
) -> DataFrame:
    """Rank the nodes of graphs that have the same pairs and other weights, in one loop.

    ``graphs`` gives each ranking the graph and its weight column; the result
    ``(by…, id, <name>…)`` has in each column what `pagerank` finds for that graph.
    """
    keys = list(by)
    tags = [""] if len(graphs) == 1 else [f"_{number}" for number in range(len(graphs))]
    if len(graphs) == 1:
        table = as_table(_weighted(*next(iter(graphs.values())), keys), "graph")
    else:
        table = _merged(list(graphs.values()), keys, tags)
    weights = _weights(table, tags)
    measures = {f"out_weight{tag}": f"w{tag}" if f"w{tag}" in weights else None for tag in tags}
    strength = as_table(node_strengths(table, keys, measures), "strength")
    number: Callable[[str], Column] = F.col
    if keys or {table.schema[end].dataType.typeName() for end in ("src", "dst")} != {"long"}:
        seed = _free_seed(strength, keys)
        number = lambda node: _number(keys, node, seed)
    edges = table.select(*keys, *(number(end).alias(end) for end in ("src", "dst")), *weights)
    nodes = strength.withColumns({"id": number("id"), "name": F.col("id")})
    state = _placed(edges, nodes.drop("name"), keys, [], part_edges, CORE_CELLS, tags)
    tables = [table, strength, *state.tables]
    cached: list[DataFrame] = []
    spark = table.sparkSession
    partitions = state.partitions or int(spark.conf.get(PARTITIONS_SETTING))
    with setting(spark, PLACED_SETTING, "false"), setting(spark, PARTITIONS_SETTING, str(partitions)):
        for done in range(1, iterations):
            ranks = pagerank_step(state, damping).ranks
            if done % checkpoint_every == 0:
                ranks = as_table(ranks, "ranks")
                tables.append(ranks)
                while cached:
                    cached.pop().unpersist()
            else:
                ranks = ranks.persist(StorageLevel.MEMORY_AND_DISK)
                cached.append(ranks)
            state = state._replace(ranks=ranks)
        nodes = nodes.select(*keys, "id", "name")
        if iterations:
            last = _updated(state, nodes, state.edges if state.every is None else state.every, damping)
        else:
            each = nodes.groupBy(*keys).agg((1.0 / F.count("*")).alias("start"))
            last = _with_slice(nodes, each, keys, state.slices)
            last = last.select("*", *[F.col("start").alias(f"rank{tag}") for tag in tags])
        found = [F.col(f"rank{tag}").alias(name) for tag, name in zip(tags, graphs, strict=True)]
        result = as_table(last.select(*keys, F.col("name").alias("id"), *found), "ranks")
    for ranks in cached:
        ranks.unpersist()
    state.release()
    for part in tables:
        drop_table(part)
    return result


def pagerank(
    graph: DataFrame,
    weight: str | None = None,
    by: Sequence[str] = (),
    damping: float = 0.85,
    iterations: int = 10,
    part_edges: int | None = None,
    checkpoint_every: int = 5,
) -> DataFrame:
    """Rank the nodes of ``graph(by…, src, dst[, weight])``: ``(by…, id, rank)``.

    A fixed number of iterations from ``1 / n``; the rank of nodes that send to
    nobody is spread over their slice, so the ranks of a slice sum to 1. Lineage is cut
    after every ``checkpoint_every`` iterations and after the last.
    """
    return pageranks({"rank": (graph, weight)}, by, damping, iterations, part_edges, checkpoint_every)


def rank_mass(ranks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of nodes and total rank per slice; the total is 1 up to rounding."""
    return ranks.groupBy(*by).agg(
        F.count("*").alias("nodes"), F.sum("rank").alias("mass")
    )


def check_mass(ranks: DataFrame, by: Sequence[str] = (), tolerance: float = 1e-9) -> None:
    """Raise if the ranks of any slice do not sum to 1."""
    off = rank_mass(ranks, by).where(F.abs(F.col("mass") - 1.0) > tolerance).first()
    if off is not None:
        raise ValueError(f"rank mass is not 1: {off.asDict()}")
