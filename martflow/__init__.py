"""Retail analytics on Spark: lazy DataFrame operators, sources, sinks and named queries."""
