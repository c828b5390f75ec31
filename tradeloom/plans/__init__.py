"""Marts, measures, reports and the end-to-end batch run."""
