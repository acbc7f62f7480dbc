"""Whole jobs: from an extract to the tables a chart reads."""
