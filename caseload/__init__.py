"""Caseload and enrolment analytics as Spark DataFrame transformations."""
