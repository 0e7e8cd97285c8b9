"""Whole jobs: the layered build, training and scoring."""
