"""Reading landings and source tables, writing layers."""
