"""Table contracts, readers, repair of raw files, and writers."""
