"""Jobs: the operators put together with sources and tables."""
