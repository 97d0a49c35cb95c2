"""Every operator as a query on the given tables, with the SQL that checks it.

An order stands for a playlist, a line for a track on it and a part for a song. Embeddings and
the numeric columns of lines and parts are the features.
"""
