"""Training-data operators (token counts, dedup, language, quality, archives,
packing, fingerprints, decontamination). Nothing else in the library imports
this subpackage."""
