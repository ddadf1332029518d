"""Runnable jobs, and the queries of the driver contract."""
