"""Relational operators of the analytics pipeline (DataFrame -> DataFrame)."""
