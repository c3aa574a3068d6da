"""Named queries (``catalog``), their DuckDB oracles (``oracle``) and the analytics as Spark SQL (``sql``)."""
