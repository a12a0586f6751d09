"""tidemark: market-stream analytics on PySpark (batch and Structured Streaming)."""

__version__ = "0.1.0"
