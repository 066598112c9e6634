"""Training-data operators: ten dealt methods, their queries and their SQL.

Nothing outside this package imports it.  ``QUERIES`` maps each registered
query name to ``f(spark, sf_dir) -> DataFrame`` and ``ORACLES`` maps the names
that SQL can express to DuckDB text.
"""

from tessera.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
