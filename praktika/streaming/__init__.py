"""streaming of praktika."""
