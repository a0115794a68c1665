"""marmita: a food-delivery lakehouse written as PySpark DataFrame and streaming jobs."""
