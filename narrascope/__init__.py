"""Complaint-text analytics and retrieval as Spark DataFrame operators."""
