"""starq: data quality, cleaning and star-schema building as Spark DataFrame plans."""
