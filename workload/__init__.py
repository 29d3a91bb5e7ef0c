"""Queries of the library over the driver's tables, with the SQL that must give the same rows."""
