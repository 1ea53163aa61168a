"""Readers, schema registry and sinks."""
