"""PySpark-native analytics for auditable product-image and colour data."""
