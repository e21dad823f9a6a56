"""streaming of vitrina."""
