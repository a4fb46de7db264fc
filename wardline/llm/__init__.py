"""Operators for building training data, their queries and SQL counterparts."""
