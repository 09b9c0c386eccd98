"""Spark jobs that load untidy sales workbooks into one fact table and report on it."""
