"""DataFrame operators: lineage, history, quality checks and distributed ranking."""
