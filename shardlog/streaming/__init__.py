"""Stateful operators on live logs."""
