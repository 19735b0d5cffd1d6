"""tidewatch.operators."""
