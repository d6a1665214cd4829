"""Registered queries over the supplied tables, one module per operator family."""
