"""Log-event ETL as Spark DataFrame transformations."""
