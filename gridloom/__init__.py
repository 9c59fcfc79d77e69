"""Spark jobs that turn loosely structured statistical workbooks into curated fact tables."""
