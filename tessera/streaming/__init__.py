"""streaming of the volumetric engine."""
