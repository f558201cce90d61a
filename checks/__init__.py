"""Every operator as a query over the driver tables, beside plain SQL that must agree."""
