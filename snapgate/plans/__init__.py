"""Jobs: the operators put together for one snapshot or a back-fill of many."""
