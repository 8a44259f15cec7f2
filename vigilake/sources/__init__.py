"""vigilake.sources."""
