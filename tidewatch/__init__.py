"""Operations analytics on Spark: logs, metrics, incidents and remediation as DataFrame operators."""
