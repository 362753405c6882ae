"""cardrisk.plans."""
