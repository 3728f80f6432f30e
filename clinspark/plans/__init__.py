"""Whole jobs, composed of sources, operators and sinks."""
