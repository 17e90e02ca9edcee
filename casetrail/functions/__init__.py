"""Scalar functions. Each takes Columns and returns a Column that stays inside code generation."""
