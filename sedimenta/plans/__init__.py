"""The business plans: cleaning, star schema, questions and the whole refresh."""
