"""The same operators on data that keeps arriving."""
