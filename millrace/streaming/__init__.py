"""Micro-batch versions of the incremental operators."""
