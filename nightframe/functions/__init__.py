"""Column functions: pure expressions, no jobs, no Python code on executors."""
