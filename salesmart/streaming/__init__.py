"""Incremental refresh driven by a change stream."""
