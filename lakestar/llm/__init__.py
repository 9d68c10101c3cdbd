"""Operations of a training-data pipeline: tokenizers, near-duplicate joins,
quality and safety filters.  Nothing outside this package imports it."""
