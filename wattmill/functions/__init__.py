"""Column expressions and fixed value lists. Nothing here starts a job."""
