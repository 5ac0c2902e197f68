"""DataFrame-to-DataFrame operators: lazy, no collect, no Python code on executors."""
