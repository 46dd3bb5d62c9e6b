"""Card-payment analytics as PySpark jobs: contracts, lake, marts, reports and monitors."""
