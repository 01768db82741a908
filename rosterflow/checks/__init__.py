"""Queries over the generated test tables and their plain-SQL counterparts."""
