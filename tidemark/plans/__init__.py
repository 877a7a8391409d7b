"""The jobs: operators wired to the tables they keep."""
