"""Reporting views, dashboard queries and the registered query catalogue."""
