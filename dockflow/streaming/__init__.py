"""Structured Streaming jobs: incremental, idempotent landing of archives and raw trips."""
