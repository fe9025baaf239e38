"""Specs, the spec registry, and the jobs that read and write tables."""
