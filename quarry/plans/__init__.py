"""SQL text run on Spark (execute) and the statement catalogue it is checked with."""
