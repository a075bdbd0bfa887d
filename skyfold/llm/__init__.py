"""Training-data operators over text, vectors, web archives and chats.

Each module holds one operator and the query that applies it to a whole
table; ``queries`` collects them.  Nothing outside this package imports it.
"""
