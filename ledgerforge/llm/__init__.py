"""Operations of a training-data pipeline over documents, pages, conversations and embeddings.

Nothing outside this subpackage imports it.
"""
