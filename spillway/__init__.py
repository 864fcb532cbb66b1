"""A PySpark-native analytics engine: typed queries over files, set-based writes, tiered datasets, snapshots and introspection."""
