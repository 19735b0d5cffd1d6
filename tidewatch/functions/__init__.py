"""tidewatch.functions."""
