"""End-to-end jobs, handing over through tables."""

from mailweave.plans.stages import cluster_people, ingest, rank_people, rank_quarters

__all__ = ["cluster_people", "ingest", "rank_people", "rank_quarters"]
