"""operators of praktika."""
