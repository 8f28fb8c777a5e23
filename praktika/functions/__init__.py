"""functions of praktika."""
