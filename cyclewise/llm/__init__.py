"""Training-data operators: scans, classifiers, near-duplicate joins, mixing and sharding."""
