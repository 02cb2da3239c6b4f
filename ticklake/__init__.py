"""Chain ticks, market prices and their rollups as PySpark DataFrame functions."""
