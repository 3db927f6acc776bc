"""Feed files as streams."""
