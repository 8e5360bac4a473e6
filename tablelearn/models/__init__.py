"""Models as Estimator / Model pairs, their training loop and their evaluation."""
