"""DataFrame to DataFrame operators of the appraisal pipeline."""
