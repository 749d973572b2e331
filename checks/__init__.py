"""Registered queries over the driver's tables, and the SQL to compare with."""
