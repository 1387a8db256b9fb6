"""Operators for preparing training text: duplicates, leaks, licences, languages, toxicity, tokens, chats.

Nothing outside this folder imports it; ``queries.py`` lists the registered queries.
"""
