"""sparkiln.operators."""
