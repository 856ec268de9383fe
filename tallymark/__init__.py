"""Procure-to-pay audit analytics as Spark DataFrame transformations."""
