"""Named queries over a table directory, lakehouse layers, oracle SQL."""
