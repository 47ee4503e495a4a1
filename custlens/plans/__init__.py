"""Queries over the retail views: compositions of operators, and SQL that checks them."""
