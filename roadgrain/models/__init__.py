"""MLlib features, tree models, importances and model specifications."""
