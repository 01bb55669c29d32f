"""Readers, fixture adapters and table IO (the only module that writes)."""
