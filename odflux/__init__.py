"""Origin-destination demand analytics on Spark DataFrames, streams and ML pipelines."""

__version__ = "0.1.0"
