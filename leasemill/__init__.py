"""leasemill: Spark-native analytics over rental-contract tables."""
