"""Tarnlake: multi-source business data operations as PySpark DataFrame code."""
