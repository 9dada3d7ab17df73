"""Rows that every operator has to take: nulls, empty and blank texts, a repeated row."""

ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a text without an id"), (4, "one"), (4, "one"), (None, None)]
