"""sources of the vitals engine."""
