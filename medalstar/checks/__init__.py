"""Every operator and model as a query over the test tables, and the SQL it has to agree with."""
