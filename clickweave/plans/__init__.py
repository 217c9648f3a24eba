"""Whole-table plans: the layers, the serving rollups and the reports."""
