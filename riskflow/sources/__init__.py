"""Readers, the control table, and writers."""
