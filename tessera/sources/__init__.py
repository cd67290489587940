"""sources of the volumetric engine."""
