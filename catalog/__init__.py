"""Queries over the driver tables: Spark forms, and SQL forms that must give the same rows."""
