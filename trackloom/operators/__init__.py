"""DataFrame operators over the canonical box, frame and split tables."""
