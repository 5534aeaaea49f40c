"""A medallion analytics library for PySpark: Bronze, Silver, Gold, marts, monitors."""
