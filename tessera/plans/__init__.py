"""plans of the volumetric engine."""
