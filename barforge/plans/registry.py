"""All queries by name and their SQL for DuckDB."""

from barforge.plans.oracles import ORACLE_SQL
from barforge.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
