"""Readers and writers: landed JSON pages, bronze pages, versioned keyed tables."""
