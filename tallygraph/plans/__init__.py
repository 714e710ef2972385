"""Complete jobs composed from the operators."""
