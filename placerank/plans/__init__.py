"""Whole jobs. Each takes DataFrames and returns DataFrames; reading and writing stay outside, except
for the load functions, so a job can be run stage by stage through tables or in one go."""
