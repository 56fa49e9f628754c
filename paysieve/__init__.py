"""Payment-telemetry cleansing and risk scoring on Spark DataFrames."""
