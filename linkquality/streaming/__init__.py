"""streaming."""
