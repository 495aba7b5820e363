"""Golden values, brute force and invariants of PageRank."""

import importlib
import random
import re

import pytest
from pyspark.sql import functions as F

from mailweave.operators import (
    check_mass,
    edge_weights,
    number_nodes,
    pagerank,
    pageranks,
    rank_mass,
    simple_graph,
    top_k,
    with_names,
)

# The package exports the function under the name of its module.
module = importlib.import_module("mailweave.operators.pagerank")

# Published ranks of three very small quarters.
GOLDEN = {
    "1998-Q2": ("ab ac", {"a": 0.25974050510584634, "b": 0.3701297474470767}),
    "1998-Q3": ("ab ac ad ae af", {"a": 0.14598540152719103, "f": 0.1708029196945618}),
    "2002-Q4": ("ab cd", {"a": 0.17545293167863293, "d": 0.32454706832136704}),
}


def golden_edges(spark):
    rows = [(q, e[0], e[1]) for q, (edges, _) in GOLDEN.items() for e in edges.split()]
    return spark.createDataFrame(rows, "quarter string, src string, dst string")


def as_dict(ranks):
    return {tuple(row[:-1]): row[-1] for row in ranks.collect()}


def brute_force(edges, iterations=10, d=0.85):
    """Ranks of ``{(src, dst): w}`` by plain summation."""
    people = sorted({person for edge in edges for person in edge})
    strength = dict.fromkeys(people, 0.0)
    for (src, _), w in edges.items():
        strength[src] += w
    rank = dict.fromkeys(people, 1 / len(people))
    for _ in range(iterations):
        lost = sum(rank[p] for p in people if strength[p] == 0)
        update = dict.fromkeys(people, (1 - d + d * lost) / len(people))
        for (src, dst), w in edges.items():
            update[dst] += d * rank[src] * w / strength[src]
        rank = update
    return rank


def random_weights(seed, people=40, edges=300):
    rng = random.Random(seed)
    pairs = {}
    for _ in range(edges):
        src, dst = (f"p{int(people * rng.random() ** 2)}" for _ in range(2))
        if src != dst:
            pairs[src, dst] = float(rng.randint(1, 9)) / 2
    return pairs


def weighted_df(spark, pairs):
    return spark.createDataFrame(
        [(s, d, w) for (s, d), w in pairs.items()], "src string, dst string, w double"
    )


def test_golden_keyed(spark):
    ranks = pagerank(golden_edges(spark), by=["quarter"])
    found = as_dict(ranks)
    for quarter, (_, expected) in GOLDEN.items():
        for person, value in expected.items():
            assert found[quarter, person] == pytest.approx(value, abs=1e-12)
    tops = top_k(ranks, 20, ["quarter"]).groupBy("quarter").count().collect()
    assert {row.quarter: row["count"] for row in tops} == {
        "1998-Q2": 3, "1998-Q3": 6, "2002-Q4": 4,
    }


@pytest.mark.parametrize("quarter", GOLDEN)
def test_slice_alone_equals_slice_in_keyed_job(spark, quarter):
    found = as_dict(pagerank(golden_edges(spark).where(F.col("quarter") == quarter)))
    for person, value in GOLDEN[quarter][1].items():
        assert found[(person,)] == pytest.approx(value, abs=1e-12)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("part_edges", [None, 3])
def test_weighted_against_brute_force(spark, seed, part_edges):
    pairs = random_weights(seed)
    ranks = pagerank(weighted_df(spark, pairs), weight="w", part_edges=part_edges)
    found = {key[0]: value for key, value in as_dict(ranks).items()}
    assert found == pytest.approx(brute_force(pairs), abs=1e-13)
    check_mass(ranks)


def test_more_slices_than_can_be_broadcast(spark, monkeypatch):
    expected = as_dict(pagerank(golden_edges(spark), by=["quarter"]))
    monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 0)
    found = as_dict(pagerank(golden_edges(spark), by=["quarter"], part_edges=2))
    assert found == pytest.approx(expected, abs=1e-14)


def test_one_source_with_a_third_of_all_edges(spark):
    """A hub is cut into parts and the ranks stay the same."""
    pairs = {("hub", f"p{i}"): 1.0 for i in range(400)}
    pairs |= {(f"p{i}", f"p{(i * 7 + 1) % 400}"): 1.0 for i in range(400)}
    pairs |= {(f"p{i}", "sink"): 1.0 for i in range(400)}
    graph = weighted_df(spark, pairs).drop("w")
    state = module.start_ranks(graph, part_edges=50)
    parts = state.edges.where("src = 'hub'").groupBy("part").count().collect()
    assert len(parts) == 8
    assert max(row["count"] for row in parts) < 100
    state.release()
    found = {k[0]: v for k, v in as_dict(pagerank(graph, part_edges=50)).items()}
    assert found == pytest.approx(brute_force(pairs), abs=1e-13)


@pytest.mark.parametrize("seed", [1])
def test_placed_edges_give_the_same_ranks(spark, monkeypatch, seed):
    monkeypatch.setattr(module, "MIN_TASK_EDGES", 0)
    pairs = random_weights(seed)
    ranks = pagerank(weighted_df(spark, pairs), weight="w", part_edges=3)
    found = {key[0]: value for key, value in as_dict(ranks).items()}
    assert found == pytest.approx(brute_force(pairs), abs=1e-13)


def _exchanges_on_source(ranks):
    """Exchanges on the source in the plan that ran, be it of edges or of shares."""
    ranks.collect()
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    final = plan.split("\n+- == Initial Plan ==")[0]
    return len(re.findall(r"Exchange hashpartitioning\(src#.*ENSURE_REQUIREMENTS", final))


def test_placed_edges_are_not_moved_again(spark, monkeypatch):
    """In the second iteration only the shares of the nodes move to the source."""
    monkeypatch.setattr(module, "MIN_TASK_EDGES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = module.start_ranks(golden_edges(spark).drop("quarter").distinct())
        first = module.pagerank_step(state)
        first = first._replace(ranks=first.ranks.checkpoint())
        assert _exchanges_on_source(module.pagerank_step(first).ranks) == 1
        elsewhere = first._replace(edges=first.edges.repartition(3, "dst"))
        assert _exchanges_on_source(module.pagerank_step(elsewhere).ranks) == 2
        state.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_relabelling_and_partitioning_change_nothing(spark):
    pairs = random_weights(3)
    graph = weighted_df(spark, pairs)
    expected = as_dict(pagerank(graph, weight="w"))
    renamed = graph.repartition(17).select(
        F.concat(F.lit("x"), "src").alias("src"), F.concat(F.lit("x"), "dst").alias("dst"), "w"
    )
    found = {(key[0][1:],): v for key, v in as_dict(pagerank(renamed, weight="w")).items()}
    assert found == pytest.approx(expected, abs=1e-14)


def test_freq_of_single_to_mails_is_unweighted(spark):
    rows = [(s, d, "to", "NA") for s, d in random_weights(4)]
    edges = spark.createDataFrame(rows, "src string, dst string, type string, ym string")
    weighted = as_dict(pagerank(edge_weights(edges), weight="w"))
    assert as_dict(pagerank(simple_graph(edges))) == pytest.approx(weighted, abs=1e-14)


def test_weights(spark):
    rows = [("a", "b", "to"), ("a", "b", "to"), ("a", "b", "cc"), ("a", "a", "to")]
    edges = spark.createDataFrame(rows, "src string, dst string, type string")
    assert [row.w for row in edge_weights(edges).collect()] == [2.5]
    assert edge_weights(edges, "log").first().w == pytest.approx(2.252762968495368, abs=1e-15)
    with pytest.raises(ValueError):
        edge_weights(edges, "raw")


def test_mass(spark):
    ranks = pagerank(golden_edges(spark), by=["quarter"])
    assert all(abs(row.mass - 1) < 1e-12 for row in rank_mass(ranks, ["quarter"]).collect())
    with pytest.raises(ValueError):
        check_mass(ranks.where(F.col("id") != "a"), ["quarter"])


def test_no_iterations_gives_the_start_vector(spark):
    ranks = pagerank(golden_edges(spark), by=["quarter"], iterations=0)
    assert as_dict(ranks)["2002-Q4", "a"] == 0.25


@pytest.mark.parametrize("every", [1, 2, 5, 100])
def test_lineage_is_cut_whatever_the_checkpoints(spark, every):
    """The result is a checkpoint, equal for any distance, and nothing stays cached."""
    graph = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "a")], "src string, dst string")
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    ranks = pagerank(graph, iterations=7, checkpoint_every=every)
    assert "Join" not in ranks._jdf.queryExecution().executedPlan().toString()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    expected = {r.id: r["rank"] for r in pagerank(graph, iterations=7, checkpoint_every=1).collect()}
    assert {r.id: r["rank"] for r in ranks.collect()} == pytest.approx(expected, abs=1e-15)


def _in_cells(monkeypatch, grid):
    """Have graphs placed in that grid of cells; the plans by which ranks become tables."""
    monkeypatch.setattr(module, "MIN_TASK_EDGES", 0)
    monkeypatch.setattr(module, "_grid", lambda *counts: grid)
    plans, as_table = [], module.as_table

    def noted(df, label):
        if label == "ranks":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return as_table(df, label)

    monkeypatch.setattr(module, "as_table", noted)
    return plans


@pytest.mark.parametrize("grid", [(2, 3), (1, 4), (5, 1)])
def test_grid_of_cells_gives_the_same_ranks(spark, monkeypatch, grid):
    _in_cells(monkeypatch, grid)
    pairs = random_weights(5)
    ranks = pagerank(weighted_df(spark, pairs), weight="w")
    found = {key[0]: value for key, value in as_dict(ranks).items()}
    assert found == pytest.approx(brute_force(pairs), abs=1e-13)
    keyed = as_dict(pagerank(golden_edges(spark), by=["quarter"]))
    for quarter, (_, expected) in GOLDEN.items():
        for person, value in expected.items():
            assert keyed[quarter, person] == pytest.approx(value, abs=1e-12)


def test_dense_graph_moves_less_than_its_edges():
    """A dense graph is dealt to cells, each iteration moving fewer rows than there are edges;
    a sparse one, where that saves nothing, is not."""
    rows, columns = module._grid(200_000_000, 7_000_000, 3_500_000, 200, 50)
    assert rows * columns >= 50
    assert 7_000_000 * rows + 3_500_000 * columns < 200_000_000 / 2
    assert module._grid(160_000_000, 140_000_000, 70_000_000, 200, 50) is None


def test_cells_are_not_moved_again(spark, monkeypatch):
    """Shares move to the cells and sums to the targets; the edges stay where they are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = _in_cells(monkeypatch, (2, 3))
        pagerank(weighted_df(spark, random_weights(6)), weight="w", iterations=3, checkpoint_every=2)
        assert re.search(r"Exchange hashpartitioning\(cell#\d+, \d+\)", plans[0])
        assert not re.search(r"Exchange hashpartitioning\((cell#\d+, )?src#", plans[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nodes_that_share_a_number_get_others(spark, monkeypatch):
    """Numbers are drawn anew until no two nodes have the same."""
    number, seeds = module._number, []

    def clashing(keys, node, seed):
        seeds.append(seed)
        return number(keys, node, seed) % 3 if seed < 2 else number(keys, node, seed)

    monkeypatch.setattr(module, "_number", clashing)
    pairs = random_weights(7)
    found = as_dict(pagerank(weighted_df(spark, pairs), weight="w"))
    assert {key[0]: value for key, value in found.items()} == pytest.approx(brute_force(pairs), abs=1e-13)
    assert max(seeds) == 2


def test_unknown_nodes_keep_their_rank(spark):
    """A null id is a node that no edge reaches, and is no error."""
    rows = [("a", "b"), ("b", "a"), (None, "a"), ("b", None)]
    found = as_dict(pagerank(spark.createDataFrame(rows, "src string, dst string"), iterations=1))
    assert found[(None,)] == pytest.approx(0.15 / 3)
    assert found["a",] == pytest.approx(0.15 / 3 + 0.85 / 6)


def silent_weights(seed):
    """A graph in which most nodes send to nobody, one source alone among them."""
    rng = random.Random(seed)
    people = [f"p{i}" for i in range(60)]
    pairs = {(rng.choice(people[:12]), rng.choice(people)): rng.randint(1, 9) / 2 for _ in range(150)}
    return {p: w for p, w in pairs.items() if p[0] != p[1]} | {("alone", "p59"): 1.0}


@pytest.mark.parametrize(("part_edges", "placed"), [(None, False), (5, True)])
def test_silent_nodes_apart_give_the_same_ranks(spark, monkeypatch, part_edges, placed):
    """The loop keeps senders only, and all nodes have their rank at the end, in slices too."""
    states, heard = [], module._placed

    def noted(*args):
        states.append(heard(*args))
        return states[-1]

    monkeypatch.setattr(module, "_placed", noted)
    if placed:
        monkeypatch.setattr(module, "MIN_TASK_EDGES", 0)
        monkeypatch.setattr(module, "_grid", lambda *counts: None)
    slices = {"a": silent_weights(1), "b": silent_weights(2), "c": {("x", "y"): 0.0}}
    rows = [(q, s, d, w) for q, pairs in slices.items() for (s, d), w in pairs.items()]
    graph = spark.createDataFrame(rows, "quarter string, src string, dst string, w double")
    for iterations in (1, 4):
        found = as_dict(pagerank(graph, "w", ["quarter"], iterations=iterations, part_edges=part_edges))
        for quarter in "ab":
            expected = brute_force(slices[quarter], iterations)
            assert {k[1]: v for k, v in found.items() if k[0] == quarter} == pytest.approx(expected, abs=1e-13)
        assert found["c", "x"] == found["c", "y"] == pytest.approx(0.5)
        alone = pagerank(graph.where("quarter = 'a'").drop("quarter"), "w", iterations=iterations)
        assert {k[0]: v for k, v in as_dict(alone).items()} == pytest.approx(
            brute_force(slices["a"], iterations), abs=1e-13
        )
    for state in states:
        assert set(state.ranks.columns) >= {"lost", "held"}
    with monkeypatch.context() as patch:
        patch.setattr(module, "as_table", lambda df, label: df.checkpoint())
        patch.setattr(module, "drop_table", lambda table: None)
        state = heard(*_numbers_of(graph), ["quarter"], [], None, 2)
        senders = graph.where("w > 0").select("quarter", "src").distinct().count()
        assert module.pagerank_step(state).ranks.count() == state.nodes.count() == senders
        state.release()


def _numbers_of(graph):
    """Edges and strengths as `_placed` takes them."""
    numbered = graph.withColumns({end: F.xxhash64("quarter", end) for end in ("src", "dst")})
    return numbered, module.node_strength(numbered, ["quarter"], "w")


def test_unknown_nodes_among_silent_ones(spark):
    """Edges from and to null carry nothing, whether silent nodes are apart or not."""
    rows = [("a", "b"), (None, "b"), ("a", None), ("a", "c"), ("a", "d"), ("b", "a")]
    graph = spark.createDataFrame(rows, "src string, dst string")
    found = as_dict(pagerank(graph, iterations=2))
    first = {None: 0.0, "a": 0.2, "b": 0.05, "c": 0.05, "d": 0.05}
    first = {k: (0.15 + 0.85 * 0.4) / 5 + 0.85 * v for k, v in first.items()}
    base = (0.15 + 0.85 * (first["c"] + first["d"])) / 5
    sent = first["a"] / 4
    expected = {None: 0.0, "a": first["b"], "b": sent, "c": sent, "d": sent}
    assert found == pytest.approx({(k,): base + 0.85 * v for k, v in expected.items()}, abs=1e-15)


@pytest.mark.parametrize("grid", [None, (2, 3)])
def test_graphs_ranked_in_one_loop(spark, monkeypatch, grid):
    """One loop over graphs of the same pairs finds what each graph's own finds."""
    if grid:
        _in_cells(monkeypatch, grid)
    mails = [(s, d, kind, "NA") for n, (s, d) in enumerate(random_weights(8)) for kind in ("to", "cc")[: 1 + n % 2]]
    edges = spark.createDataFrame(mails, "src string, dst string, type string, ym string")
    graphs = {"basic": (simple_graph(edges), None)}
    graphs |= {mode: (edge_weights(edges, mode), "w") for mode in ("log", "freq")}
    ranks = pageranks(graphs)
    assert ranks.columns == ["id", "basic", "log", "freq"]
    for name, (graph, weight) in graphs.items():
        pairs = {(r.src, r.dst): r[weight] if weight else 1.0 for r in graph.collect()}
        found = {r.id: r[name] for r in ranks.collect()}
        assert found == pytest.approx(brute_force(pairs), abs=1e-13)


def test_weights_of_one_graph_may_be_missing(spark):
    """An edge that weighs nothing in one graph carries nothing there, and its nodes are known."""
    weights = [random_weights(9), {p: w * (n % 3) for n, (p, w) in enumerate(random_weights(9).items())}]
    graphs = {name: (weighted_df(spark, pairs), "w") for name, pairs in zip(("full", "part"), weights, strict=True)}
    ranks = pageranks(graphs).collect()
    for name, (graph, _) in graphs.items():
        own = {k[0]: v for k, v in as_dict(pagerank(graph, "w")).items()}
        assert {r.id: r[name] for r in ranks} == pytest.approx(own, abs=1e-14)


def test_graphs_of_other_pairs_are_an_error(spark):
    one, two = ({("a", "b"): 1.0}, {("a", "b"): 1.0, ("b", "a"): 1.0})
    with pytest.raises(ValueError, match="1 pairs"):
        pageranks({"one": (weighted_df(spark, one), "w"), "two": (weighted_df(spark, two), None)})


def test_numbered_edges_keep_their_names(spark, monkeypatch):
    """Numbers are drawn anew on a clash, ranks come back by id, and unknown ids stay unknown."""
    number, seeds = module._number, []

    def clashing(keys, node, seed):
        seeds.append(seed)
        return number(keys, node, seed) % 3 if seed < 2 else number(keys, node, seed)

    monkeypatch.setattr(module, "_number", clashing)
    pairs = random_weights(10)
    edges, names = number_nodes(weighted_df(spark, pairs))
    assert max(seeds) == 2
    found = {k[0]: v for k, v in as_dict(with_names(pagerank(edges, "w"), names)).items()}
    assert max(seeds) == 2  # numbers are not numbered again
    assert found == pytest.approx(brute_force(pairs), abs=1e-13)
    some = with_names(pagerank(edges, "w"), names.where("id = 'p1'")).collect()
    assert len(some) == len(found) and {r.id for r in some} == {None, "p1"}


def test_every_cell_is_a_partition_of_its_own(spark):
    cells = spark.createDataFrame([(n,) for n in module._labels(spark, 13)], "cell int").repartition(13, "cell")
    assert cells.select(F.spark_partition_id()).distinct().count() == 13
