"""Registered queries over the driver tables, each with its SQL where there is one."""
