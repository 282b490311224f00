"""Demand analytics for order-line exports, written as PySpark DataFrame jobs."""
