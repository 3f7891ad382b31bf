"""Tilewright: geospatial vector-tile analytics and corpus preparation on PySpark."""
