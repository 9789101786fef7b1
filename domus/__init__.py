"""domus — listings analytics on Spark: CDC, upsert, flatten, profile, models."""

__version__ = "0.1.0"
