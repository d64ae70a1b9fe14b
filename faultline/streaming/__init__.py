"""Streaming: the source library has no streaming semantics (no watermarks, event-time
windows, state or late data), so nothing is built here; every rolling window in the library is
a batch row frame over a device's history."""
