"""farelane.plans."""
