"""Ride-fare analytics as Spark jobs: ingest, clean, derive, split, sample, model, score."""
