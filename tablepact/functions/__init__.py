"""Column-level helpers: type names, lenient casts, plan size checks."""
