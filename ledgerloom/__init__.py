"""Reconciliation of financial figures, and training-data operators, as Spark jobs."""
