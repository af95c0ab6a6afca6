"""sparkiln.functions."""
