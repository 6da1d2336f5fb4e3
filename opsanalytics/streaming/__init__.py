"""Streaming entry points: a file-landing trigger that re-runs the batch job."""
