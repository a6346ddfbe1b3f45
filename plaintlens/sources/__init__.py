"""Readers and writers for the complaint, chunk, store and evaluation tables."""
