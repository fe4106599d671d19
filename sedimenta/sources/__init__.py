"""Text files in, layered tables out."""
