"""Streams of requests."""
