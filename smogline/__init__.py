"""Spark jobs over wide tables of daily measurements by place."""
