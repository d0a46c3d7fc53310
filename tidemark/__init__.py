"""Tidemark: star-schema warehouses built and kept up to date with PySpark."""
