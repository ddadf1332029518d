"""Sinks and micro-batch work of Structured Streaming."""
