"""plans of praktika."""
