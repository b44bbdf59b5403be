"""Trip-event analytics on Spark: keyed JSON events to bronze, silver and gold tables."""
