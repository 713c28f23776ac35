"""plans of the vitals engine."""
