"""Daily counts from a stream of events."""
