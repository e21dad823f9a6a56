"""plans of vitrina."""
