"""Operations of a large text-corpus pipeline: cleaning, scoring, deduplication, packing.

Nothing else in the library imports this subpackage.
"""
