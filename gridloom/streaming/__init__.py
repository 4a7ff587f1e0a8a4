"""Extensions on Structured Streaming; the batch operators have no streaming part of their own."""
