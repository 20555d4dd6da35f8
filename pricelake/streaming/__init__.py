"""Structured Streaming: land topics into a raw zone, count, reconcile."""
