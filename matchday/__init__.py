"""Sports-league analytics written as composable Spark DataFrame operators."""
