"""Return-risk analytics on Spark: features, models, ensembles, decisions."""
