"""Operations of a training-data pipeline: deduplication, quality, mixing, packing and output."""
