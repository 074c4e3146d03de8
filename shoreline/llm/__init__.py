"""Training-data operators: language id, line / vector / SimHash deduplication,
quality models and rules, mixing, BPE, token attribution, chat formatting.

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and their SQL.
"""
