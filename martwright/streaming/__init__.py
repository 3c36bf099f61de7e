"""File-stream delivery of landed data."""
