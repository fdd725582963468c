"""plans of the engine."""
