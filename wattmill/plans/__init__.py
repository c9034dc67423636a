"""Whole jobs: the refresh from files to marts, and the question bank over the marts."""
