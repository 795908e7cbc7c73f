"""Composite plans: the star schema, the analyses and the load pipeline."""
