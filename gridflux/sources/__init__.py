"""Readers, sinks and caches (SRC, SNK)."""
