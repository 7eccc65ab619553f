"""Structured Streaming forms of the hourly load. Each has a batch twin it must agree with."""
