"""Runs the engine on the star-schema test tables and states the expected results in SQL."""
