"""cardrisk.functions."""
