"""Writers: partitioned layers, metric history, gold table, scratch tables."""
