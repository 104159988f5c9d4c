"""Test data adapter, query registry and reference SQL for the driver's checks."""
