"""farelane.streaming."""
