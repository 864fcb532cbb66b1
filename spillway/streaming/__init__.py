"""Streams into versioned tables, and windowed aggregates over late data."""
