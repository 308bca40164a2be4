"""Readers for raw, bronze, silver and metric data, and snapshot discovery."""
