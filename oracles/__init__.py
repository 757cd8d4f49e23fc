"""Independent DuckDB SQL for every query that SQL can express."""
