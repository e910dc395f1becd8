"""Schemas, text scans and writers, and the driver-table views."""
