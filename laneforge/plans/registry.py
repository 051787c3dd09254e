"""All queries by name, and SQL that gives the same rows."""

from laneforge.plans import control_queries, match_queries, storage_queries, timeline_queries  # noqa: F401  they register their queries
from laneforge.plans.catalog import ORACLES, QUERIES
from laneforge.plans.match_queries import tier_list

__all__ = ["ORACLES", "QUERIES", "tier_list"]
