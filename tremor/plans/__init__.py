"""Bindings of the operators to the driver's test tables, and the query registry."""
