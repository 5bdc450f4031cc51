"""Readers, writers, artefact tables and the run table."""
