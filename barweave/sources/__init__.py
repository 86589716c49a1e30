"""Readers of landed files and the partitioned table writer."""
