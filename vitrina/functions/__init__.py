"""functions of vitrina."""
