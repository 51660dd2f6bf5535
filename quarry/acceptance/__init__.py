"""Acceptance queries: one function per operator, each over the given tables."""
