"""Batch writers. Streaming counterparts are in ``twinflow.streaming``."""
