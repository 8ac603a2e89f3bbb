"""Learners and the batch jobs built from the operators."""
