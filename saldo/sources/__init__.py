"""sources of the payment analytics library."""
