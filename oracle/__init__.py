"""ANSI SQL (run by DuckDB) that says what each registered query must return."""
