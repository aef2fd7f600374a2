"""Job plans, fixture inputs and the query registry."""
