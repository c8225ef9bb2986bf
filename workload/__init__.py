"""Driver-facing queries: input adapters, Spark queries and their SQL checks."""
