"""Column-level functions: pure expressions, no DataFrame and no Python UDF."""
