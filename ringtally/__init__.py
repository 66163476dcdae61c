"""Usage-event analytics on Spark: one set of DataFrame functions for batch and stream."""
