"""Column expressions used by the jobs; all are built-in Spark functions."""
