"""Sinks: exports, fingerprints and published snapshots."""
