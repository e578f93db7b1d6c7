"""The registered queries over the benchmark tables, and the same questions in plain SQL."""
