"""Registry of queries (Spark) and their DuckDB oracle statements."""

from triplake.catalog.oracle import oracle_sql  # noqa: F401
from triplake.catalog.queries import QUERIES, lake_for  # noqa: F401
