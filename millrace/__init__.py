"""Millrace: a PySpark-native engine for catalogue analytics and text-corpus preparation."""
