"""Marts, their contracts and the three end-to-end jobs."""
