"""tidelog: change-data capture analytics and corpus preparation on PySpark."""
