"""Request scheduling as streams, and a batcher for callers that hold futures."""
