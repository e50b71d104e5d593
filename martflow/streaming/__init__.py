"""Change feed as Structured Streaming queries."""
