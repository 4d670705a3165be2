"""Composite flows (silver, gold, reports, pipeline) and the registered query catalog."""
