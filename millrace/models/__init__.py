"""The catalogue's tables as functions of its raw records and of the last release's history."""
