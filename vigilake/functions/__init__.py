"""vigilake.functions."""
