"""The registered queries: test-table projection, queries, and their SQL twins."""
