"""Column expressions: no job, no Python in the hot path."""
