"""DuckDB SQL that restates every registered query (the correctness oracle)."""
