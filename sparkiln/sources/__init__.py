"""sparkiln.sources."""
