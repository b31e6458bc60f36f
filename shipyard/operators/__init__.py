"""DataFrame -> DataFrame operators: validation, de-duplication, milestones,
shipment assembly and quality checks."""
