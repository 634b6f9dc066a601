"""Reusable Column and DataFrame helpers."""
