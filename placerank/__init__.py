"""Rank places from messy tabular, geographic and event data, on Spark DataFrames.

functions/  Column builders: text, codes, geography, scores
operators/  DataFrame -> DataFrame: cleaning, statistics, spatial joins, ranking, de-duplication
sources/    readers and writers
plans/      whole jobs composed from the operators
streaming/  the event stream with its bronze, silver and gold tables
"""
