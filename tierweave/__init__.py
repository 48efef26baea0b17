"""Layered batch tables (bronze, silver, gold) built from Spark DataFrame functions."""
