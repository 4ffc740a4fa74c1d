"""All registered queries: importing the query modules fills the shared dicts."""

from quartermaster.plans import dimension_queries, job_queries, operator_queries, publish_queries, source_queries  # noqa: F401  (register queries)
from quartermaster.streaming import queries as stream_queries  # noqa: F401
from quartermaster.plans.table_queries import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
