"""farelane.functions."""
