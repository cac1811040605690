"""Training-data operators over a table of documents.

One module per operator; ``queries`` registers one query for each.  Nothing
else in the library imports this subpackage.
"""
