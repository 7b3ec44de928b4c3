"""Governed medallion analytics as Spark DataFrame transformations."""
