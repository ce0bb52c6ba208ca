"""Queries over the test tables, each with its SQL equivalent where one exists."""

from gridloom.registry import column_queries, job_queries, model_queries, profile_queries, split_queries
from gridloom.registry.inputs import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "column_queries", "job_queries", "model_queries", "profile_queries", "split_queries"]
