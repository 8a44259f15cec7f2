"""vigilake.plans."""
