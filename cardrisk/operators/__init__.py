"""cardrisk.operators."""
