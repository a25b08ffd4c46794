"""DataFrame-level building blocks that hold up under key skew."""
