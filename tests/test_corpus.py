"""Numbers of the derived corpora, computed once from the tables with SQL."""

import pytest
from pyspark.sql import functions as F

from mailweave.operators import (
    FEATURES,
    build_edges,
    cluster_sizes,
    dangling_nodes,
    edge_weights,
    kmeans,
    pagerank,
    parse_messages,
    person_features,
    quarter_sizes,
    simple_graph,
    top_k,
)
from mailweave.sources import orders_mail
from tests.conftest import TESTDATA


def test_counts(parsed):
    edges = build_edges(parsed)
    assert edges.count() == 5648
    assert edges.where("type = 'cc'").count() == 1758
    assert edges.where("ym = 'NA'").count() == 2665
    assert edges.select("ym").distinct().count() == 45
    assert quarter_sizes(edges).count() == 15
    assert dangling_nodes(simple_graph(edges)).count() == 49


def test_parsed_edges_are_the_edges_of_the_tables(spark, sf_dir, parsed):
    by_text, by_table = build_edges(parsed), orders_mail.edges(spark, sf_dir)
    assert by_text.exceptAll(by_table).count() == 0
    assert by_table.exceptAll(by_text).count() == 0


@pytest.mark.parametrize(
    ("mode", "score"), [("freq", 0.008119234694), ("log", 0.007318412456)]
)
def test_most_central_by_volume(spark, sf_dir, mode, score):
    weights = edge_weights(orders_mail.edges(spark, sf_dir), mode)
    best = top_k(pagerank(weights, weight="w"), 1).first()
    assert (best.email, round(best.pagerank, 12)) == ("p7@en.example.com", score)


def test_cluster_sizes_after_five_iterations(spark):
    sf_dir = TESTDATA / "sf0.01"
    if not sf_dir.is_dir():
        pytest.skip("no test data")
    parsed = parse_messages(orders_mail.messages(spark, str(sf_dir)))
    features = person_features(parsed).checkpoint()
    means = features.agg(*[F.round(F.avg(c), 4).alias(c) for c in FEATURES]).first()
    assert tuple(means) == (28.5513, 28.2678, 28.2678, 0.1888, 0.4219, 3.5538, 6.7749)
    for k, expected in {3: [386, 514, 1090], 4: [167, 510, 793, 520]}.items():
        fit = kmeans(features, FEATURES, k, iterations=5, tol=0.0)
        sizes = {row.cluster: row.people for row in cluster_sizes(fit.assignments).collect()}
        assert [sizes[number] for number in range(k)] == expected
