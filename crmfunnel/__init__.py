"""CRM funnel and calling analytics as lazy PySpark DataFrame functions."""
