"""citypulse: urban-mobility analytics on Spark."""
