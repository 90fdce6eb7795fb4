"""Readers and the versioned table publication."""
