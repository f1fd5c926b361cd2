"""Sources: Kafka, incrementally arriving JSON files, tables, JDBC, and the
adapters that present the driver's test tables in the payment domain."""
