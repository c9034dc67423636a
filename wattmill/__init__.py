"""Electricity-market analytics on Spark: files to tables to daily marts to answers."""
