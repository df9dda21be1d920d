"""End-to-end plans: registered queries, training and scoring flows."""
