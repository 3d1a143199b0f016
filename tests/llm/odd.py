"""Rows that every operator must take."""

ODD_TEXTS = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "x"), (9005, "word " * 40_000), (9005, "word " * 40_000),
             (9006, "é漢😀   ñ"), (None, "a text without an id, twice"), (None, "a text without an id, twice")]
