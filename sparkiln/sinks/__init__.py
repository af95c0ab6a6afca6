"""sparkiln.sinks."""
