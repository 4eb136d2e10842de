"""Jobs made of the operators, and the queries that check them."""
