"""wattline: time-series cleaning, features, forecasting and drift checks as Spark jobs."""
