"""Streaming entry points.

The reference has no streaming jobs (no watermarks, event-time windows or
stateful operators). Its batch cleaning steps are stateless DataFrame
transformations, so the same functions apply unchanged to a
``readStream`` source; this package only wires them to one.
"""

from tabulon.streaming.trips import clean_trip_stream

__all__ = ["clean_trip_stream"]
