"""Snapshot documents to star schema, as Spark DataFrame operators."""
