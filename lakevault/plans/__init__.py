"""Composed flows (bronze -> vault -> gold), the stand-in bindings used by
``__spark_entry__``, their SQL specifications, and plan inspection helpers."""
