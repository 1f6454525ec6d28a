"""DuckDB SQL equivalents of the registered queries, paired with them in the
registry (``oracle_sql()``) for differential tests; the plan-building code
never uses them."""
