"""Queries over the given tables: the engine's tables and operators, each with its SQL check."""
