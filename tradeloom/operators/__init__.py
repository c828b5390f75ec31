"""Relational operators of the warehouse: joins, rules, FX, dimensions, facts, merges."""
