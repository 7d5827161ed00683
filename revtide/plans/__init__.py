"""Reports and derived tables."""
