"""Operators for large training-text corpora: tokenising, chat formatting,
packing, de-duplication at several grains, language identification,
fingerprints and surrogate generation. Nothing else in the library imports
this subpackage."""
