"""Motion-sensor analytics on Spark: packets, sessions, scoring, aggregates and serving views."""
