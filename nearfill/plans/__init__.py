"""Query plans over the driver's test tables and the end-to-end run."""
