"""Readers and the published-artifact store."""
