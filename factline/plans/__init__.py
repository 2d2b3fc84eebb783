"""Workspaces, declared pipelines, the ingest job and checkpoints."""
