from tideway.plans.registry import ORACLES, QUERIES
from tideway.plans import stream_queries, table_queries, topic_queries, live_queries  # noqa: F401  (registers the queries)

__all__ = ["ORACLES", "QUERIES"]
