"""Table-to-table operators; each takes a DataFrame and column names."""
