"""Operations on training text: filters, duplicates, encodings, scores, packing."""
