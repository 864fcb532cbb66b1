"""Sources: files, table functions, SQL of unknown shape, snapshots."""
