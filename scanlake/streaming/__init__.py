"""Structured Streaming: record streams, fan-out, keyed sinks, completion barrier."""
