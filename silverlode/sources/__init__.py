"""Readers, writers and the driver-table adapters."""
