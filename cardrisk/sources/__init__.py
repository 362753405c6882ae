"""cardrisk.sources."""
