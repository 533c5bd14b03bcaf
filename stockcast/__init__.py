"""Panel demand forecasting and inventory-cost analytics as Spark DataFrame jobs."""
