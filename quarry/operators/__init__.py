"""DataFrame operators the stages compose: distribution, layout, schema evolution."""
