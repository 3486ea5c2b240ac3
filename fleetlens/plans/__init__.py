"""Queries that run the operators over the driver tables, each with its SQL equivalent."""
