"""Registered queries, with the SQL each is compared against."""
