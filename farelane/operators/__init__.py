"""farelane.operators."""
