"""Binds the library's plans to the star-schema test tables and states the expected SQL."""
