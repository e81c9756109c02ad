"""Training-data operators: cleaning, mixing, matching and encoding of text corpora.

One module per operator; ``queries`` holds the registered queries. Nothing else
in the library imports this package.
"""
