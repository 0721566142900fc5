"""Registered queries on the test tables, their oracle SQL, and the frames they are run on."""
