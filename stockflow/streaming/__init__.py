"""Loading landed pages as a stream."""

from stockflow.streaming.pages import stream_pages_to_raw

__all__ = ["stream_pages_to_raw"]
