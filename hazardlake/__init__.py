"""hazardlake: hazard-event analytics expressed as Spark DataFrame plans."""
