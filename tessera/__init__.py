"""Tessera: civic-data analytics as PySpark DataFrame plans."""
