#: nulls, blanks, repeated rows and ids, null ids, odd characters, a special token, one long text
ODD_ROWS = [
    (1, "Hello world, it's 2024.  Tabs\tand\nlines \n end "), (2, None), (3, ""), (4, " \n\t "), (5, "naïve Übung 東京 🙂 x y"),
    (1, "Hello world, it's 2024.  Tabs\tand\nlines \n end "), (None, "no id at all"), (None, None), (6, "a<|endoftext|> b <|endoftext|>c"),
    (7, "z" * 3000 + " word" * 4000), (5, "another row of id five"),
]
