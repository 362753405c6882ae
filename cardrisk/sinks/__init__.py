"""cardrisk.sinks."""
