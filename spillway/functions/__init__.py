"""Scalar and aggregate functions with the engine's NULL, NaN, index and rounding rules, as Column expressions."""
