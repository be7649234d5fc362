SMALL, MIDDLE, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, doc string, row string, node int, seed string, n string, h string, item int"


def edge_rows() -> list[tuple]:
    same = "one two three four five six seven eight nine ten eleven twelve"
    texts = [
        None, "", " \t\n", "word", "été ça où 東京 \U0001f600", same, same, same.upper(), "a b\na b\n\na b",
        ("lorem ipsum dolor sit amet " * 8000) + "end", "x" * 30_000, "##### $$$ <<>> | & %", "the " * 40,
        "mail a.b@c.de, ip 10.0.0.1 card 4111 1111 1111 1111 phone +49 (30) 1234-5678 <|endoftext|> end",
    ]
    rows = [(i, t, "en" if i % 2 else None, ["s", None, ""][i % 3], None, "d", "r", 1, None, "n", "h", i) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, "a row without an id but with some words in it, twelve or so", None, None, None, None, None, None, None, None, None, None))
    return rows
