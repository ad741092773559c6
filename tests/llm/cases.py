"""Rows that every operator must take."""

#: Nulls in any column, empty and white texts, ties, repeated rows, odd characters, long texts.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "a row without an id"), (None, None),
       (5, "one"), (6, "Ünïcödé 漢字 \x85 　 words 😀 <|endoftext|> end"), (7, "a a a a a a a a a a a a a a a a a a a a"),
       (8, "long " * 30_000), (9, "x" * 50_000), (10, "tab\tsep\x0bvt\x0cff\rcr\nnl")]
