"""DataFrame -> DataFrame operators (lazy; no actions except the checks)."""
