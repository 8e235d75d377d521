"""Independent DuckDB SQL versions of the registered queries (correctness oracle)."""
