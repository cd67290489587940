"""operators of the volumetric engine."""
