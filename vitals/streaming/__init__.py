"""streaming of the vitals engine."""
