"""Operations of a training-data pipeline: filters, joins, scores, packing and record files."""
