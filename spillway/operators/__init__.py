"""Operators over DataFrames: relational helpers, set-based writes, exports, tiered datasets, geometry."""
