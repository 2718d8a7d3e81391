"""Structured Streaming forms: event-time columns and watermarks, sinks,
stream-safe aggregates, stream-stream interval joins and stateful
processors (``transformWithStateInPandas``) for the keyed rules."""
