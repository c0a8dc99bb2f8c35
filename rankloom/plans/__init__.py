"""Specs, composite jobs and the registered driver queries."""
