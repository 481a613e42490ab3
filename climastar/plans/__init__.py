"""Composed plans: cleansed sources, the star model, reports, the batch."""
