"""Landing readers, flatteners, and source-selection operators."""
