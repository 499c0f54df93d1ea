"""Daily demand analytics for perishable stock, as DataFrame-to-DataFrame functions on Spark."""
