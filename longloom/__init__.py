"""longloom: long-context training data, built with Spark DataFrames.

``sources`` reads and filters corpora, ``functions`` holds column expressions,
``operators`` the relational building blocks, ``plans`` whole queries over the
driver's tables and ``streaming`` the file-stream variants.
"""
