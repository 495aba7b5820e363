"""DataFrame to DataFrame operators."""

from mailweave.operators.features import (
    FEATURES,
    active_months,
    degrees,
    night_ratio,
    person_counts,
    person_features,
    sent_recv,
)
from mailweave.operators.graph import (
    dangling_nodes,
    edge_weights,
    node_strength,
    node_strengths,
    nodes,
    out_strength,
    quarter_sizes,
    simple_graph,
    with_quarter,
)
from mailweave.operators.kmeans import (
    KMeansResult,
    assign,
    cluster_centers_raw,
    cluster_crosstab,
    cluster_profile,
    cluster_sizes,
    collect_centroids,
    collect_stats,
    column_stats,
    init_centroids,
    kmeans,
    kmeans_many,
    standardize,
    update_centroids,
)
from mailweave.operators.messages import (
    build_edges,
    explode_recipients,
    gate_messages,
    header_fields,
    ingest_metrics,
    mapped_fields,
    parse_fields,
    parse_messages,
    persons,
    skip_reasons,
)
from mailweave.operators.pagerank import (
    check_mass,
    number_nodes,
    pagerank,
    pagerank_step,
    pageranks,
    rank_mass,
    rank_vector,
    start_ranks,
    with_names,
)
from mailweave.operators.ranking import (
    global_vs_quarterly,
    peak_quarter,
    quarter_winner,
    rank_compare,
    seed_emails,
    series_wide,
    top_k,
    track,
)
from mailweave.operators.summary import scale_summary
from mailweave.operators.temporal import (
    active_streaks,
    asof_join,
    conversation_sessions,
    interval_join,
    mails_in_intervals,
    reply_latency,
    rolling_activity,
    sessions,
)
from mailweave.operators.traffic import (
    calendar_rollup,
    edge_changes,
    edge_churn,
    traffic_cells,
    traffic_cube,
)

__all__ = [
    "FEATURES",
    "KMeansResult",
    "active_months",
    "active_streaks",
    "asof_join",
    "assign",
    "build_edges",
    "calendar_rollup",
    "check_mass",
    "cluster_centers_raw",
    "cluster_crosstab",
    "cluster_profile",
    "cluster_sizes",
    "collect_centroids",
    "collect_stats",
    "column_stats",
    "conversation_sessions",
    "dangling_nodes",
    "degrees",
    "edge_changes",
    "edge_churn",
    "edge_weights",
    "explode_recipients",
    "gate_messages",
    "global_vs_quarterly",
    "header_fields",
    "ingest_metrics",
    "init_centroids",
    "interval_join",
    "kmeans",
    "kmeans_many",
    "mails_in_intervals",
    "mapped_fields",
    "night_ratio",
    "node_strength",
    "node_strengths",
    "nodes",
    "number_nodes",
    "out_strength",
    "pagerank",
    "pagerank_step",
    "pageranks",
    "parse_fields",
    "parse_messages",
    "peak_quarter",
    "person_counts",
    "person_features",
    "persons",
    "quarter_sizes",
    "quarter_winner",
    "rank_compare",
    "rank_mass",
    "rank_vector",
    "reply_latency",
    "rolling_activity",
    "scale_summary",
    "seed_emails",
    "sent_recv",
    "series_wide",
    "sessions",
    "simple_graph",
    "skip_reasons",
    "standardize",
    "start_ranks",
    "top_k",
    "track",
    "traffic_cells",
    "traffic_cube",
    "update_centroids",
    "with_names",
    "with_quarter",
]
