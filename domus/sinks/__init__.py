"""domus.sinks."""
