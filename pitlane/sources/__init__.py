"""Readers and writers of the session, season and serving tables."""
