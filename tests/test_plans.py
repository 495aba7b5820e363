"""What the plans must and must not hold, so that they stay good at scale."""

import pytest

from mailweave import sources
from mailweave.operators import (
    build_edges,
    edge_weights,
    ingest_metrics,
    parse_messages,
    person_features,
    simple_graph,
    top_k,
    with_quarter,
)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages") / "m")
    df = spark.createDataFrame([("1", "From: a@b.c\nTo: d@e.f")], sources.tables.MESSAGE_SCHEMA)
    sources.write_messages(df, path)
    return sources.read_messages(spark, path, "parquet")


@pytest.fixture(scope="module")
def edges_path(spark, messages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "e")
    sources.write_edges(build_edges(parse_messages(messages)), path)
    return path


def test_parsing_is_narrow_and_reads_the_text_once(messages):
    plan = physical(build_edges(parse_messages(messages)))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("FileScan") == 1
    # Each header is searched once: no filter repeats the search.
    for name in ("From", "To", "Cc", "Date"):
        assert plan.count(rf"\n{name}:(") == 1


@pytest.mark.parametrize(("operator", "shuffles"), [(ingest_metrics, 2), (person_features, 2)])
def test_one_scan_for_several_measures(messages, operator, shuffles):
    plan = physical(operator(parse_messages(messages)))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == shuffles


def test_edges_are_pruned_at_the_scan(spark, edges_path):
    edges = sources.read_edges(spark, edges_path, fields=2)
    plan = physical(simple_graph(edges))
    assert "ReadSchema: struct<src:string,dst:string>" in plan
    assert "IsNotNull(src), IsNotNull(dst)" in plan
    edges = sources.read_edges(spark, edges_path, fields=3)
    plan = physical(edge_weights(edges))
    assert "ReadSchema: struct<src:string,dst:string,type:string>" in plan
    assert "partial_sum" in plan


def test_quarters_by_month_partition(spark, messages, tmp_path):
    edges = build_edges(parse_messages(messages))
    sources.write_edges(edges, str(tmp_path / "e"), partition_by=["ym"])
    read = sources.read_edges(spark, str(tmp_path / "e"))
    plan = physical(with_quarter(read).where("ym = '2001-05'"))
    assert "PartitionFilters: [isnotnull(ym" in plan


def test_top_k_takes_without_a_full_sort(spark):
    ranks = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "id string, rank double")
    assert "TakeOrderedAndProject(limit=1" in physical(top_k(ranks, 1))



@pytest.mark.parametrize("name", ["night_ratio", "conversation_sessions", "sql_quarter_sizes", "mails_in_own_intervals"])
def test_filters_do_not_parse_the_mails_again(spark, sf_dir, name):
    import __spark_entry__

    plan = __spark_entry__.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "From:(" not in plan and "collect_list" not in plan


def test_dates_are_added_up_and_header_blocks_cut_once(spark, messages):
    from mailweave.operators import header_fields

    plan = parse_messages(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lpad(") == 2  # hours and minutes of one zone
    plan = header_fields(messages, headers_only=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\r?") + plan.count(r"\r?") == 1
