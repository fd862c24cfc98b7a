"""Readers, record decoders and writers."""
