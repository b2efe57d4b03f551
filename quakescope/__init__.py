"""quakescope — seismic catalogue analytics on Spark (DataFrame, Catalyst, MLlib, Structured Streaming)."""

__version__ = "0.1.0"
