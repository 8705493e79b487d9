"""Continuous intake on file-source streams."""
