"""sources of praktika."""
