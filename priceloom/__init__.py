"""Price-page analytics and corpus preparation as PySpark DataFrame operators."""
