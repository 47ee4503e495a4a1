"""Readers, writers, header mapping and the logical retail views."""
