"""Raw, stage and analytics layers over messy business extracts, as Spark plans."""
