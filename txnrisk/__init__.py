"""Payment-transaction risk analytics as DataFrame operators on Spark."""
