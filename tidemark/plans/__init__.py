"""Registered queries over the test tables, grouped as in the operator inventory."""
