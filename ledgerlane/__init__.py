"""Reconciliation marts over ride-hailing and workforce feeds, as Spark DataFrame jobs."""
