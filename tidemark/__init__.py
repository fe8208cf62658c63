"""Record linkage and longitudinal presence analytics as Spark DataFrame plans."""
