"""Marts, reports, operational views and the three-layer run."""
