"""Ready-made queries."""
