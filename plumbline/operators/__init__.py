"""Dataset operators."""
