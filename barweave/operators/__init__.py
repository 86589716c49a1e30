"""DataFrame to DataFrame steps without I/O."""
