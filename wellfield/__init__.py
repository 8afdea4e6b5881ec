"""Well analytics on Spark: production, forecasts, economics, spacing and fluids as DataFrame operators."""
