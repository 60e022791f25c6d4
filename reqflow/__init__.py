"""reqflow: set-based procurement analytics and corpus preparation on PySpark."""
