"""Queries over the driver tables and the assembly workflow."""
