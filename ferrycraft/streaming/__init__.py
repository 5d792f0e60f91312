"""Incremental, restartable copies."""
