"""DataFrame -> DataFrame operators: positions, edits, repair, profiles, layouts and fitted column transforms."""
