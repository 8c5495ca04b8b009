"""Operations of a training-data pipeline: cleaning, search, mixing, language, tokens, scoring."""
