"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""
