"""saldo: payment analytics as Spark DataFrame operators."""
