"""Streaming use: applying a trained tree to a stream (stateless, stream-static joins)."""

from canopy.streaming.predict_stream import predict_stream, running_error

__all__ = ["predict_stream", "running_error"]
