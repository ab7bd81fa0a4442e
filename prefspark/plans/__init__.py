"""Whole jobs: each is one lazy plan from input tables to the result."""
