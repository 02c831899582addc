"""Rental-kiosk analytics written as PySpark DataFrame plans."""
