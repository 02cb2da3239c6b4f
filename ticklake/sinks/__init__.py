"""Idempotent table writers and partition maintenance."""
