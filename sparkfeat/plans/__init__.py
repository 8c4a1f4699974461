"""Feature builders and pipelines on the credit tables."""
