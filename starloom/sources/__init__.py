"""Sources and sinks: JSON / CSV landing, versioned Parquet layer tables,
forecast records, and the raw-sales view over the driver's tables."""
