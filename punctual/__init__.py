"""Punctuality analytics on Spark: load nested day files, flatten them into an
event fact, roll the fact up into exactly mergeable tables and answer reports."""
