"""domus.streaming."""
