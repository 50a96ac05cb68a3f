"""Sinks, cursors and streams."""
