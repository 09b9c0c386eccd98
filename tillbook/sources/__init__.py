"""Workbook folders, the staging table and the star schema."""
