"""Corpus, vocabulary, training, similarity and expansion operators."""
