"""Named jobs built from the operators: topic loads, conversions, snapshots, and
the catalog of queries over the driver's test tables."""
