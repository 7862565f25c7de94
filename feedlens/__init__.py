"""Content-feed event analytics and recommendations as PySpark DataFrame functions."""
