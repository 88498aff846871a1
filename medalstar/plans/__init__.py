"""The layers: bronze flattening, silver cleaning, gold star schema, marts, checks."""
