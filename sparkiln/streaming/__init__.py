"""sparkiln.streaming."""
