"""Readers for ticks, market snapshots and stored tables."""
