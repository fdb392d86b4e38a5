"""Composed jobs: fixture roles, ETL stages, the pipeline and the query registry."""
