"""Quarters that arrive while the pipeline runs."""
