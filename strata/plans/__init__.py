"""Jobs, the ordered pipeline, and physical-plan inspection helpers."""
