"""

Graph queries start from the edges derived straight from the tables; parsing,
feature and clustering queries start from the rendered raw mails.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mailweave import operators as op
from mailweave import sources
from mailweave.functions import clean_address, header_map, is_valid_address, quarter_of
from mailweave.functions.addresses import SEPARATORS
from mailweave.operators.features import FEATURES
from mailweave.session import as_table, shared_folder, stage_path
from mailweave.sources import orders_mail
from mailweave.sql import register
from mailweave.streaming import closed_weeks, count_new_files, late_copies, parse_new_files
from oracles import oracle_sql as _oracle_sql

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---- raw mails --------------------------------------------------------------


def _read_messages(spark, sf_dir):
    path = stage_path(spark, "messages")
    sources.write_messages(orders_mail.messages(spark, sf_dir), path, "csv")
    return sources.read_messages(spark, path)


def _read_large_dump(spark, sf_dir):
    path = stage_path(spark, "dump")
    sources.write_messages(orders_mail.messages(spark, sf_dir), path, "csv")
    return sources.read_large_dump(spark, path)


def _incremental_edges(spark, sf_dir):
    dump, folder = stage_path(spark, "dump"), stage_path(spark, "ingest")
    sources.write_messages(orders_mail.messages(spark, sf_dir), dump, "csv")
    parse_new_files(spark, dump, folder)
    return op.build_edges(spark.read.parquet(f"{folder}/parsed"))


def _persons_roundtrip(spark, sf_dir):
    path = stage_path(spark, "persons")
    sources.write_persons(op.persons(_parsed(spark, sf_dir)), path, "text")
    return spark.read.text(path).select(F.col("value").alias("email"))


def _header_fields(spark, sf_dir):
    return op.header_fields(orders_mail.messages(spark, sf_dir))


def _kept(parsed):
    """The parsed mails as a table: a filter on what was parsed reads that table, and does not have
    the mails parsed again for each of its terms."""
    path = stage_path(parsed.sparkSession, "parsed")
    parsed.write.parquet(path)
    return parsed.sparkSession.read.schema(parsed.schema).parquet(path)


def _parsed(spark, sf_dir):
    return _kept(op.parse_messages(orders_mail.messages(spark, sf_dir)))


def _parsed_odd(spark, sf_dir, headers_only=False):
    return op.parse_messages(orders_mail.odd_messages(spark, sf_dir), headers_only=headers_only)


def _odd_mails(headers_only: bool) -> Query:
    """Everything parsed from mails with missing, folded, forwarded or unreadable parts."""

    def query(spark, sf_dir):
        listed = {c: F.array_join(c, ",") for c in ("to", "cc")}
        return _parsed_odd(spark, sf_dir, headers_only).withColumns(_clock("sent_at") | listed)

    return query


def _skip_reasons_all(spark, sf_dir):
    """Mails per reason over both corpora; every reason there is occurs."""
    return op.skip_reasons(_parsed(spark, sf_dir).union(_parsed_odd(spark, sf_dir)))


def _sent_local(spark, sf_dir):
    """Month and hour in another zone than the mails'."""
    parsed = op.parse_messages(orders_mail.messages(spark, sf_dir), tz="America/Chicago")
    return parsed.select("msg_id", "ym", "hour")


def _edges_headers_only(spark, sf_dir):
    messages = orders_mail.messages(spark, sf_dir)
    return op.build_edges(_kept(op.parse_messages(messages, headers_only=True)))


def _tokens(spark, sf_dir):
    fields = F.array("to_text", "cc_text")
    field = _header_fields(spark, sf_dir).select(F.explode(fields).alias("field"))
    return (
        field.where(F.col("field") != "")
        .select(F.explode(F.split("field", SEPARATORS)).alias("token"))
        .select(F.trim("token").alias("token"))
    )


def _clean_address(spark, sf_dir):
    return (
        _tokens(spark, sf_dir)
        .groupBy("token", clean_address(F.col("token")).alias("address"))
        .agg(F.count("*").alias("times"))
    )


def _valid_address(spark, sf_dir):
    valid = is_valid_address(clean_address(F.col("token"))).alias("is_valid")
    return _tokens(spark, sf_dir).groupBy(valid).agg(F.count("*").alias("tokens"))


def _recipients(spark, sf_dir):
    return op.explode_recipients(_parsed(spark, sf_dir)).drop("sent_at")


# ---- mails over time --------------------------------------------------------


def _clock(*cols):
    """Times as text, which reads the same in every engine."""
    return {c: F.col(c).cast("string") for c in cols}


def _reply_latency(spark, sf_dir):
    return op.reply_latency(_parsed(spark, sf_dir)).withColumns(_clock("sent_at"))


def _periods(spark, sf_dir):
    """Periods of interest, one per event: the month of the events stretched over the years of
    the mails, and as many hours as the event's value."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    since = F.col("ts").cast("timestamp_ntz") - F.lit("2024-01-01").cast("timestamp_ntz")
    start = F.lit("1998-01-01").cast("timestamp_ntz") + since * 44
    seconds = F.floor(F.col("value") * 3600).cast("decimal(18,6)")
    return events.select(
        F.col("event_id").alias("id"),
        "event_type",
        orders_mail.address(F.col("user_id")).alias("src"),
        start.alias("start"),
        (start + F.make_dt_interval(secs=seconds)).alias("end"),
    )


def _mails_in_intervals(spark, sf_dir):
    errors = _periods(spark, sf_dir).where("event_type = 'error'").select("id", "start", "end")
    return op.mails_in_intervals(_parsed(spark, sf_dir), errors).withColumns(_clock("first_at"))


def _mails_in_own_intervals(spark, sf_dir):
    """Every mail with the periods of its sender that it falls in."""
    mails = _parsed(spark, sf_dir).where("skip_reason IS NULL").select("msg_id", "src", "sent_at")
    pairs = op.interval_join(mails, _periods(spark, sf_dir), "sent_at", "start", "end", by=["src"])
    return pairs.select("point.msg_id", "interval.id", "interval.event_type")


def _conversation_sessions(spark, sf_dir):
    bursts = op.conversation_sessions(_parsed(spark, sf_dir), gap=180 * 86400)
    return bursts.withColumns(_clock("started", "ended"))


def _rolling_activity(spark, sf_dir):
    return op.rolling_activity(_parsed(spark, sf_dir)).withColumns(_clock("window_start"))


def _in_two_arrivals(spark, sf_dir, first, delay):
    """The folder of a stream that took the mails for which ``first`` holds in one run and the
    others, which arrived later, in the next."""
    dump, folder = stage_path(spark, "dump"), stage_path(spark, "weeks")
    messages = orders_mail.messages(spark, sf_dir)
    for arrival, mails in enumerate((messages.where(first), messages.where(~first))):
        sources.write_messages(mails, f"{dump}/arrival={arrival}", "csv")
        count_new_files(spark, f"{dump}/*", folder, delay, 100_000, state_store="memory")
    return folder


def _edges_per_week_stream(spark, sf_dir):
    """Closed weeks of mails that arrive year by year, so that none is late."""
    year = F.regexp_extract("message", r"\nDate: [^\n]*? (\d{4}) ", 1)
    folder = _in_two_arrivals(spark, sf_dir, year < "2000", "28 days")
    return closed_weeks(spark, folder).withColumns(_clock("week_start"))


def _late_copies_stream(spark, sf_dir):
    """Every tenth mail arrives after all others: what is late then, and what is not."""
    number = F.regexp_extract("file", "[0-9]+", 0).cast("long")
    folder = _in_two_arrivals(spark, sf_dir, number % 10 != 3, "365 days")
    weeks = closed_weeks(spark, folder).agg(F.count("*").alias("weeks"), F.sum("edges").alias("edges"))
    runs = late_copies(spark, folder).agg(
        F.count("*").alias("runs"), F.sum("late_copies").alias("late_copies"), F.sum("mails").alias("mails")
    )
    as_rows = lambda df: df.unpivot([], df.columns, "measure", "value")
    return as_rows(weeks).union(as_rows(runs))


# ---- traffic, formats and SQL -----------------------------------------------


def _edge_changes(spark, sf_dir):
    """Copies of two quarters in a row, by what became of them."""
    dated = op.with_quarter(_kept_edges(spark, sf_dir))
    first, second = (dated.where(F.col("quarter") == q) for q in ("1998-Q1", "1998-Q2"))
    return op.edge_changes(first, second)


def _header_map(spark, sf_dir):
    """Every header field of every mail, its values in one text."""
    fields = F.explode(header_map(F.col("message"))).alias("name", "found")
    mails = orders_mail.messages(spark, sf_dir).select("file", fields)
    return mails.select("file", "name", F.array_join("found", "|").alias("found"))


def _json_edges(spark, sf_dir):
    path = stage_path(spark, "json")
    sources.write_messages_json(orders_mail.messages(spark, sf_dir), path)
    mails = sources.read_messages_json(spark, path)
    return op.build_edges(_kept(op.parse_fields(op.mapped_fields(mails))))


def _json_corrupt(spark, sf_dir):
    """Lines read whole, with an unknown field, and not at all, from a file in which every
    seventh line is cut short and every eleventh has a field more."""
    path, damaged = stage_path(spark, "json"), stage_path(spark, "damaged")
    sources.write_messages_json(orders_mail.messages(spark, sf_dir), path)
    number = F.regexp_extract("value", r'"file":"mail/(\d+)', 1).cast("long")
    short = F.substring("value", F.lit(1), F.length("value") - 1 - (number % 5).cast("int"))
    more = F.concat(F.lit('{"size":'), number.cast("string"), F.lit(","), F.substring("value", F.lit(2), F.length("value")))
    line = F.when(number % 7 == 0, short).when(number % 11 == 0, more).otherwise(F.col("value"))
    spark.read.text(path).select(line.alias("value")).write.text(damaged)
    mails = sources.read_messages_json(spark, damaged)
    kind = F.when(F.col("corrupt").isNotNull(), "corrupt").when(F.size("rest") > 0, "unknown field").otherwise("whole")
    return mails.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("mails"), F.sum(F.col("rest")["size"].cast("long")).alias("size")
    )


def _edges_format(fmt: str) -> Query:
    def query(spark, sf_dir):
        path = stage_path(spark, f"edges-{fmt}")
        sources.write_edges(_edges(spark, sf_dir), path, fmt)
        return sources.read_edges(spark, path, fmt)

    return query


def _edges_bucketed(spark, sf_dir):
    """Every pair with its share of the sender's copies, from a table dealt by sender: neither
    the sums nor the join moves an edge."""
    path = stage_path(spark, "bucketed")
    name = path.rpartition("/")[2].replace("-", "_")
    kept = _kept_edges(spark, sf_dir)
    edges = sources.edges_table(kept, name, path, sources.bucket_count(kept))
    pairs = edges.groupBy("src", "dst").agg(F.count("*").alias("copies"))
    sent = edges.groupBy("src").agg(F.count("*").alias("sent"))
    shares = pairs.join(sent.hint("merge"), "src")
    spark.sql(f"DROP TABLE {name}")  # the files stay for the plan that reads them
    return shares.select("src", "dst", "copies", "sent")


def _in_sql(text: str) -> Query:
    def query(spark, sf_dir):
        register(spark, _parsed(spark, sf_dir))
        return spark.sql(text)

    return query


_sql_quarter_sizes = _in_sql(
    """SELECT mail_quarter(ym) AS quarter, count(DISTINCT src, dst) AS edges FROM mail_edges
       WHERE src <> dst AND mail_quarter(ym) IS NOT NULL GROUP BY mail_quarter(ym)"""
)
_sql_edge_weights = _in_sql(
    """SELECT src, dst, sum(mail_weight(type)) AS w FROM mail_edges
       WHERE src <> dst AND mail_valid_address(src) GROUP BY src, dst"""
)
_sql_correspondents = _in_sql(
    """SELECT email, sent, received FROM mail_correspondents('p7@en.example.com')"""
)


# ---- graph ------------------------------------------------------------------


def _edges(spark, sf_dir):
    return orders_mail.edges(spark, sf_dir)


def _edges_roundtrip(spark, sf_dir):
    path = stage_path(spark, "edges")
    sources.write_edges(_edges(spark, sf_dir), path, "tsv")
    return sources.read_edges(spark, path, "tsv")


def _edges_short_lines(spark, sf_dir):
    """Lines kept and left out per number of required fields, from a list whose lines are
    short or have empty fields, by the number in the recipient's address."""
    number = F.regexp_extract("dst", "[0-9]+", 0).cast("long") % 5
    line = (
        F.when(number == 0, F.concat_ws("\t", "src", "dst"))
        .when(number == 1, F.concat_ws("\t", "src", "dst", F.lit(""), "ym"))
        .when(number == 2, F.concat_ws("\t", "src", "dst", F.lit("")))
        .otherwise(F.concat_ws("\t", "src", "dst", "type", "ym"))
    )
    path = stage_path(spark, "short-lines")
    _edges(spark, sf_dir).select(line.alias("value")).write.text(path)
    rows = []
    for fields in (2, 3, 4):
        kept = sources.read_edges(spark, path, "tsv", fields)
        weight = F.sum(F.when(F.col("type") == "cc", 0.5).otherwise(1.0))
        measures = {
            "kept": F.count("*").cast("double"),
            "weight": weight,
            "dated": F.count(quarter_of(F.col("ym"))).cast("double"),
        }
        named = [F.struct(F.lit(k).alias("measure"), F.col(k).alias("value")) for k in measures]
        counted = kept.agg(*[v.alias(k) for k, v in measures.items()]).select(F.inline(F.array(*named)))
        left_out = sources.count_short_lines(spark, path, "tsv", fields).select(
            F.lit("left_out").alias("measure"), F.col("short_lines").cast("double").alias("value")
        )
        rows.append(counted.union(left_out).select(F.lit(fields).alias("fields"), "measure", "value"))
    return rows[0].union(rows[1]).union(rows[2])


def _simple(spark, sf_dir):
    return op.simple_graph(_edges(spark, sf_dir))


def _weights(mode: str) -> Query:
    return lambda spark, sf_dir: op.edge_weights(_edges(spark, sf_dir), mode)


def _weights_log(spark, sf_dir):
    return _rounded(_weights("log")(spark, sf_dir), 10, "w")


# ---- centrality -------------------------------------------------------------


def _kept_edges(spark, sf_dir):
    """The edges as a table, for queries that rank them more than once."""
    path = stage_path(spark, "edges")
    sources.write_edges(_edges(spark, sf_dir), path)
    return sources.read_edges(spark, path, fields=2)


def _rank_basic(edges):
    return op.pagerank(op.simple_graph(edges))


def _rank_weighted(edges, mode):
    return op.pagerank(op.edge_weights(edges, mode), weight="w")


def _rank_quarterly(edges):
    dated = op.with_quarter(edges)
    return op.pagerank(op.simple_graph(dated, by=["quarter"]), by=["quarter"])


def _basic(spark, sf_dir):
    return _rank_basic(_edges(spark, sf_dir))


def _weighted(mode: str) -> Query:
    return lambda spark, sf_dir: _rank_weighted(_edges(spark, sf_dir), mode)


def _quarterly(spark, sf_dir):
    return _rank_quarterly(_edges(spark, sf_dir))


def _ranked(ranks: Query) -> Query:
    return lambda spark, sf_dir: _rounded(ranks(spark, sf_dir), 10, "rank")


def _scored(query: Query) -> Query:
    return lambda spark, sf_dir: _rounded(query(spark, sf_dir), 10, "pagerank")


def _pagerank_step(spark, sf_dir):
    return op.rank_vector(op.pagerank_step(op.start_ranks(_simple(spark, sf_dir))))


def _rank_mass(spark, sf_dir):
    return _rounded(op.rank_mass(_quarterly(spark, sf_dir), ["quarter"]), 9, "mass")


def _top20(spark, sf_dir):
    return op.top_k(_basic(spark, sf_dir))


def _top20_quarterly(spark, sf_dir):
    return op.top_k(_quarterly(spark, sf_dir), by=["quarter"])


def _tracked_seed(spark, sf_dir):
    path = stage_path(spark, "ranking")
    sources.write_result(_top20(spark, sf_dir), path, header=False, single=True)
    return sources.read_ranking(spark, path, 5)


def _tracked(spark, sf_dir):
    edges, names = op.number_nodes(_kept_edges(spark, sf_dir))
    seeds = op.seed_emails(op.top_k(op.with_names(_rank_basic(edges), names)), 5)
    tracked = F.broadcast(names.where(F.col("id").isin(seeds)))
    return op.track(op.with_names(_rank_quarterly(edges), tracked), seeds), seeds


def _tracked_series(spark, sf_dir):
    return _tracked(spark, sf_dir)[0]


def _series_wide(cap: float | None) -> Query:
    def query(spark, sf_dir):
        series, seeds = _tracked(spark, sf_dir)
        names = [f"seed_{place}" for place in range(1, len(seeds) + 1)]
        return _rounded(op.series_wide(series, seeds, cap, names), 10, *names)

    return query


def _peak_quarter(spark, sf_dir):
    return op.peak_quarter(_tracked_series(spark, sf_dir))


def _rank_compare(spark, sf_dir):
    edges, names = op.number_nodes(_kept_edges(spark, sf_dir))
    graphs = {"basic": (op.simple_graph(edges), None)}
    graphs |= {mode: (op.edge_weights(edges, mode), "w") for mode in ("log", "freq")}
    ranks = as_table(op.with_names(op.pageranks(graphs), names), "ranks")
    tops = (op.top_k(ranks.select("id", F.col(name).alias("rank"))) for name in graphs)
    return op.rank_compare(*tops)


def _global_vs_quarterly(spark, sf_dir):
    edges = _kept_edges(spark, sf_dir)
    quarters = op.top_k(_rank_quarterly(edges), by=["quarter"])
    return op.global_vs_quarterly(op.top_k(_rank_basic(edges)), quarters)


# ---- features and clusters --------------------------------------------------


def _on_parsed(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_parsed(spark, sf_dir))


_features = _on_parsed(op.person_features)


def _features_roundtrip(spark, sf_dir):
    path = stage_path(spark, "features")
    sources.write_features(_features(spark, sf_dir), path, "tsv")
    return sources.read_features(spark, path, "tsv")


def _feature_stats(spark, sf_dir):
    return _rounded(op.column_stats(_features(spark, sf_dir), FEATURES), 8, "mean", "std")


def _scaled(spark, sf_dir):
    shared_folder(spark)
    features = _features(spark, sf_dir).checkpoint()
    return op.standardize(features, FEATURES, *op.collect_stats(features, FEATURES))


def _zscores(spark, sf_dir):
    return _rounded(_scaled(spark, sf_dir), 8, *FEATURES)


def _centroid_table(spark, centroids, digits):
    rows = [(number, *centre) for number, centre in enumerate(centroids)]
    schema = ", ".join(["cluster int", *[f"{c} double" for c in FEATURES]])
    return _rounded(spark.createDataFrame(rows, schema), digits, *FEATURES)


def _initial(spark, sf_dir, k):
    """Standardised points and the K starting centres."""
    scaled = _scaled(spark, sf_dir)
    return scaled, op.collect_centroids(op.init_centroids(scaled, k), FEATURES)


def _init_centroids(spark, sf_dir):
    return _centroid_table(spark, _initial(spark, sf_dir, 4)[1], 8)


def _kmeans_assign(spark, sf_dir):
    scaled, centroids = _initial(spark, sf_dir, 3)
    return op.assign(scaled, FEATURES, centroids).select("email", "cluster")


def _kmeans_step(spark, sf_dir):
    scaled, centroids = _initial(spark, sf_dir, 3)
    return _centroid_table(spark, op.update_centroids(scaled, FEATURES, centroids), 6)


def _kmeans(spark, sf_dir):
    fit = op.kmeans(_features(spark, sf_dir), FEATURES, k=3, iterations=5, tol=0.0)
    return _centroid_table(spark, fit.centroids, 6)


def _members(k: int) -> Query:
    return lambda spark, sf_dir: op.kmeans(_features(spark, sf_dir), FEATURES, k).assignments


def _kmeans_embeddings(spark, sf_dir):
    dims = [f"e{i}" for i in range(64)]
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", *[F.col("embedding")[i].alias(name) for i, name in enumerate(dims)]
    )
    return op.kmeans(vectors, dims, k=4, id_col="vec_id").assignments


def _cluster_sizes(spark, sf_dir):
    return op.cluster_sizes(_members(4)(spark, sf_dir))


def _cluster_centers(spark, sf_dir):
    fit = op.kmeans(_features(spark, sf_dir), FEATURES, 4)
    return _rounded(op.cluster_centers_raw(fit, FEATURES), 6, *FEATURES)


def _cluster_profile(spark, sf_dir):
    shared_folder(spark)
    features = _features(spark, sf_dir).checkpoint()
    labels = {number: f"group_{number}" for number in range(4)}
    members = op.kmeans(features, FEATURES, 4).assignments
    profile = op.cluster_profile(members, features, FEATURES, 4, labels)
    return _rounded(profile, 6, *FEATURES)


def _cluster_crosstab(spark, sf_dir):
    fits = op.kmeans_many(_features(spark, sf_dir), FEATURES, [3, 4])
    return op.cluster_crosstab(fits[3].assignments, fits[4].assignments)


# ---- contract ---------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The 20 most central people of the sf0.001 corpus."""
    return _top20(spark, "/root/testdata/sf0.001")


def _added() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and oracles of the training-data operators, where they and what they need can be
    imported; the mail queries do not depend on them."""
    functions: dict[str, Query] = {}
    texts: dict[str, str] = {}
    try:
        from mailweave.llm import queries as added
    except ImportError:
        return functions, texts
    functions |= added.queries()
    texts |= added.oracle_sql()
    try:
        import corpus_pipeline
    except ImportError:
        return functions, texts
    functions["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        texts["pipeline"] = corpus_pipeline.ORACLE_SQL
    return functions, texts


def queries() -> dict[str, Query]:
    return _mail_queries() | _added()[0]


def _mail_queries() -> dict[str, Query]:
    return {
        # sources and message parsing
        "read_messages": _read_messages,
        "read_large_dump": _read_large_dump,
        "incremental_edges": _incremental_edges,
        "header_fields": _header_fields,
        "clean_address": _clean_address,
        "valid_address": _valid_address,
        "recipients": _recipients,
        "persons": _on_parsed(op.persons),
        "persons_roundtrip": _persons_roundtrip,
        "skip_reasons": _on_parsed(op.skip_reasons),
        "skip_reasons_all": _skip_reasons_all,
        "odd_mails": _odd_mails(False),
        "odd_mails_headers_only": _odd_mails(True),
        "sent_month": lambda spark, sf_dir: _parsed(spark, sf_dir).select("msg_id", "ym"),
        "sent_hour": lambda spark, sf_dir: _parsed(spark, sf_dir).select("msg_id", "hour"),
        "sent_local": _sent_local,
        "edges": _on_parsed(op.build_edges),
        "edges_headers_only": _edges_headers_only,
        "edges_roundtrip": _edges_roundtrip,
        "edges_short_lines": _edges_short_lines,
        "ingest_metrics": _on_parsed(op.ingest_metrics),
        "scale_summary": _on_parsed(op.scale_summary),
        # mails over time
        "reply_latency": _reply_latency,
        "mails_in_intervals": _mails_in_intervals,
        "mails_in_own_intervals": _mails_in_own_intervals,
        "conversation_sessions": _conversation_sessions,
        "rolling_activity": _rolling_activity,
        "active_streaks": _on_parsed(op.active_streaks),
        "edges_per_week_stream": _edges_per_week_stream,
        "late_copies_stream": _late_copies_stream,
        # traffic, formats and SQL
        "traffic_cube": lambda spark, sf_dir: op.traffic_cube(_edges(spark, sf_dir)),
        "calendar_rollup": lambda spark, sf_dir: op.calendar_rollup(_edges(spark, sf_dir)),
        "edge_churn": lambda spark, sf_dir: op.edge_churn(_edges(spark, sf_dir)),
        "edge_changes": _edge_changes,
        "header_map": _header_map,
        "json_edges": _json_edges,
        "json_corrupt": _json_corrupt,
        "edges_orc": _edges_format("orc"),
        "edges_json": _edges_format("json"),
        "edges_bucketed": _edges_bucketed,
        "sql_quarter_sizes": _sql_quarter_sizes,
        "sql_edge_weights": _sql_edge_weights,
        "sql_correspondents": _sql_correspondents,
        # graph
        "simple_graph": _simple,
        "graph_nodes": lambda spark, sf_dir: op.nodes(_simple(spark, sf_dir)),
        "out_degree": lambda spark, sf_dir: op.out_strength(_simple(spark, sf_dir)),
        "dangling_nodes": lambda spark, sf_dir: op.dangling_nodes(_simple(spark, sf_dir)),
        "edge_weights_freq": _weights("freq"),
        "edge_weights_log": _weights_log,
        "quarter_edges": lambda spark, sf_dir: op.with_quarter(_edges(spark, sf_dir)),
        "quarter_sizes": lambda spark, sf_dir: op.quarter_sizes(_edges(spark, sf_dir)),
        # centrality
        "pagerank": _ranked(_basic),
        "pagerank_freq": _ranked(_weighted("freq")),
        "pagerank_log": _ranked(_weighted("log")),
        "pagerank_quarterly": _ranked(_quarterly),
        "pagerank_step": _ranked(_pagerank_step),
        "rank_mass": _rank_mass,
        "top20": _scored(_top20),
        "top20_quarterly": _scored(_top20_quarterly),
        "tracked_seed": _scored(_tracked_seed),
        "tracked_series": _scored(_tracked_series),
        "series_wide": _series_wide(None),
        "series_wide_capped": _series_wide(0.001),
        "rank_compare": _rank_compare,
        "quarter_winner": _scored(lambda spark, sf: op.quarter_winner(_quarterly(spark, sf))),
        "peak_quarter": _scored(_peak_quarter),
        "global_vs_quarterly": _global_vs_quarterly,
        # features
        "sent_recv": _on_parsed(op.sent_recv),
        "degrees": _on_parsed(op.degrees),
        "night_ratio": _on_parsed(op.night_ratio),
        "active_months": _on_parsed(op.active_months),
        "person_features": _features,
        "features_roundtrip": _features_roundtrip,
        # clusters
        "feature_stats": _feature_stats,
        "zscores": _zscores,
        "init_centroids": _init_centroids,
        "kmeans_assign": _kmeans_assign,
        "kmeans_step": _kmeans_step,
        "kmeans": _kmeans,
        "kmeans_k3": _members(3),
        "kmeans_k4": _members(4),
        "kmeans_embeddings": _kmeans_embeddings,
        "cluster_sizes": _cluster_sizes,
        "cluster_centers": _cluster_centers,
        "cluster_profile": _cluster_profile,
        "cluster_crosstab": _cluster_crosstab,
    }


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | _added()[1]
