"""plans of the payment analytics library."""
