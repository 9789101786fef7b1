"""domus.operators."""
