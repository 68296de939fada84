"""Warehouse reconciliation and repair as set-based PySpark jobs."""
