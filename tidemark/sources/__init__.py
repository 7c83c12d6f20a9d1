"""Feeds, staging files, stored tables and the operational log."""
