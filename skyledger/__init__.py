"""Flight delay and cancellation analytics as plain PySpark DataFrame functions."""
