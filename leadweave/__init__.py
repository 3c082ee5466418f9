"""leadweave: contact-data analytics expressed as Spark plans."""
