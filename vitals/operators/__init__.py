"""operators of the vitals engine."""
