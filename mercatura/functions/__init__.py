"""Column helpers: keys, calendar arithmetic and exact rounded measures."""
