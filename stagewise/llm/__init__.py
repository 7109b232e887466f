"""Operators of a training-data pipeline over documents, pages, embeddings and conversations.

Nothing else in the library imports this subpackage. ``registry`` lists the
queries ``opN_<name>``; each operator module keeps a general interface of its
own and the queries derive their contract columns from it.
"""
