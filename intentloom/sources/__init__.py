"""Readers, sinks and the views that stand in for production tables."""
