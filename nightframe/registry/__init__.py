"""Registered queries over the given tables, each with its equivalent SQL where SQL can state it."""
