"""Marts, reports and pipelines composed from the operators."""
