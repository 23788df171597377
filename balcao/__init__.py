"""Retail analytics on Spark: layered tables, marts, audit questions and data generation."""
