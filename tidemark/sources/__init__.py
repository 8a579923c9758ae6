"""Readers and writers: source tables, staged files, job settings, profiles."""
