"""Warehouse build, model flows and the registered queries."""
