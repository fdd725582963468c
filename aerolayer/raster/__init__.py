"""raster of the engine."""
