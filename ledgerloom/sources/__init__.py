"""Readers, contracts, the lake and its sinks."""
