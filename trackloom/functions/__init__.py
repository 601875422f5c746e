"""Column expressions: geometry, annotation fields and text rules."""
