"""Sales ingestion and cleansing as Spark jobs: CSV folders in, a clean table by month out."""
