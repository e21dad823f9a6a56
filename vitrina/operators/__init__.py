"""operators of vitrina."""
