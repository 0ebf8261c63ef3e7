"""Whole marts, panels and the rebuild job, composed from the operators."""
