"""Model plans, scoring, and the registered query catalogue."""
