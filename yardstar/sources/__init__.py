"""Readers, extraction, the versioned store and input fixtures."""
