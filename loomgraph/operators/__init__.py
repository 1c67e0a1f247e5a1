"""Layouts, filters, partitioning, paging and algorithms over graphs."""
