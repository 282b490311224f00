"""Readers of order exports, the calendar, the station dimension and earlier results."""
