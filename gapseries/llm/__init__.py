"""Training-data operators on Spark DataFrames (see each module's docstring).

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five.
"""
