"""sparkiln.plans."""
