"""Monitoring of feeds that arrive as a stream."""
