"""Retail-sales warehouse jobs on Spark: landing files to star schema."""
