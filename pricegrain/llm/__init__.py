"""Training-data operators: near-duplicate removal, scans, packing, classifiers, mixing and search.

Nothing else in the library imports this subpackage; ``queries.py`` registers its queries.
"""
