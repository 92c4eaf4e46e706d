"""Point-in-time activity analytics as plain PySpark DataFrame functions."""
