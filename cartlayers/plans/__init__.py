"""Table builders of the cleaned and business layers, and the runs that store them."""
