"""The surveillance domain as data, and the batch plans built from the operators."""
