"""Reports and the layer jobs built from the operators."""
