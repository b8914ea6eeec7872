"""Extensions beyond batch: the stateless operators on streams, and windowed counts with watermarks."""
