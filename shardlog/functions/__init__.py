"""Scalar functions: Column builders and small driver-side helpers on column metadata."""
