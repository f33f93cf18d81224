"""Operations of a training-data pipeline: extraction, tokens, private data, licences, duplicates, quality, scoring, leaks."""
