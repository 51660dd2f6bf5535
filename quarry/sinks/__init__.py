"""Writing: save modes, staged overwrite and publish, partition expiry."""
