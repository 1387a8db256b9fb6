"""Runnable streaming jobs, one per stage of the warehouse.

Each ``start`` function starts its queries over ``Topics`` and returns them.  A
query keeps its progress under ``checkpoint``; restarting it there goes on where it
stopped.
"""
