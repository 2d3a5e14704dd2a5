"""Change feeds as streams."""
