"""operators of the payment analytics library."""
