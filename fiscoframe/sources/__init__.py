"""Table readers, reference dimensions, sinks and small state tables."""
