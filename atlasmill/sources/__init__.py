"""Readers and writers of formats."""
