"""Batch and streaming ingestion of workbook folders."""
