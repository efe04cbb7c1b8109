"""Registered query catalogue: ``queries()`` and ``oracle_sql()``."""

from postlake.plans.registry import all_queries, all_oracle_sql  # noqa: F401
