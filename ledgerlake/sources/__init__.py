"""Sources: the driver tables mapped to the sales model, files and catalog tables."""
