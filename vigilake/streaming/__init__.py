"""vigilake.streaming."""
