"""Query plans as values: captured, explained and replayed."""
