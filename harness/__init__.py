"""Feeds the engine from the generated test tables and checks it against SQL.

Not part of the library: ``raw_tables`` derives the three raw domain tables from
the test tables, ``catalog`` names the queries, ``oracles`` holds their SQL twins.
"""
