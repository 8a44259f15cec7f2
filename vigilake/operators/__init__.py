"""vigilake.operators."""
