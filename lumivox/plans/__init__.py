"""Plans: parameters, fixtures over the driver tables, registered queries and the stage runner."""
