"""sources of vitrina."""
