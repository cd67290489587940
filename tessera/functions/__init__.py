"""functions of the volumetric engine."""
