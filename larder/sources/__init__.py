"""Readers, writers and the layered lake."""
