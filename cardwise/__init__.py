"""Point-in-time card-transaction analytics on Spark: per-card features, evaluation,
decisions and monitoring, identical in batch and in streams."""

__version__ = "0.1.0"
