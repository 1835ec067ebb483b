"""Credit-risk analytics on Spark: dated snapshots in, features, labels, scores and monitoring tables out."""

__version__ = "0.1.0"
