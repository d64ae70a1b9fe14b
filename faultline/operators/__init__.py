"""Operators: lazy DataFrame -> DataFrame functions."""
