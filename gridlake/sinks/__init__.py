"""Writers for measurement, topology, result and report tables."""
