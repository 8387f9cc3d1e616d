"""Structured Streaming: stateful operators, sinks and the runner."""
