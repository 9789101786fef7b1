"""domus.sources."""
