"""Training-data operators: packing, archives, token counts, decontamination, language, quality, secrets, joins, search, LM."""
