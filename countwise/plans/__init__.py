"""Composed plans: one-row reports (C1-C5), fixed parameters of the
registered queries, and the query catalogue with its DuckDB oracle SQL."""
