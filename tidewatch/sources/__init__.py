"""tidewatch.sources."""
