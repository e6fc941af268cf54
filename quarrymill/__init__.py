"""Quarrymill: demand, ingest and review analytics as PySpark DataFrame operators."""
