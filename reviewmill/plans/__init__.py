"""Composed plans: the daily panel, its diagnostics, and forecasts."""
