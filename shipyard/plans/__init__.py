"""Layer builds (silver, gold), the run order, SQL access and reports."""
