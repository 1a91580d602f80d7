"""Ruling-corpus analytics as Spark jobs: every step is DataFrame -> DataFrame."""
