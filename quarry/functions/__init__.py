"""Small pure helpers: identifiers and SQL parameters."""
