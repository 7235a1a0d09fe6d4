"""Queries over the driver tables, one per operator, each with its SQL twin where SQL can say it."""
