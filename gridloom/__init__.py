"""Tabular profiling, preparation and regression modelling as Spark jobs."""
