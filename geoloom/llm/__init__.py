"""Operators of a training-data pipeline: cleaning, de-duplication, decontamination, packing and output of token ids."""
