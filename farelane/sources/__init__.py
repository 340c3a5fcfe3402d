"""farelane.sources."""
