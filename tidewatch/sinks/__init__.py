"""tidewatch.sinks."""
