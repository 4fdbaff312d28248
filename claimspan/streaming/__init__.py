"""Watermark loads and file streams."""
