"""functions of the payment analytics library."""
