"""Marts, reports, access patterns, metrics and monitors built from the operators."""
