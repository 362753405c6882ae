"""cardrisk.streaming."""
