"""Structured Streaming: event decode, routing, bounded batches, stream-to-staging."""
