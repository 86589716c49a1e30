"""Incremental forms: catching up on landed days, and bars over a tick stream."""
