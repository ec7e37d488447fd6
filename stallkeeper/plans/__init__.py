"""Business jobs: queries, layered ETL, data quality, validation, features."""
