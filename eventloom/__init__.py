"""Clinical event preparation on Spark: raw register tables to one longitudinal event cohort."""
