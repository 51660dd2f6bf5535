"""Streaming guards: extract and load refuse streaming frames."""
