"""Composite plans: star build, cleaning, KPIs, layer flow."""
