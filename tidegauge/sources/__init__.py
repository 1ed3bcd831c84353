"""Sources, gates and sinks."""
