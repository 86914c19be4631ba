"""Readers of raw delimited files, the typed loader, sinks and file manifests."""
