"""Column-level helpers: lenient casts and strftime-mask matching."""
