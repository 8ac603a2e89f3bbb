"""Streaming sources, sinks and jobs."""
