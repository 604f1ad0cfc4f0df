import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rk string, h int, part int, oid int"


def _texts():
    r = random.Random(7)
    syll = ["an", "be", "ko", "ri", "té", "su", "ma", "lo", "ßen", "vi"]
    word = lambda: "".join(r.choice(syll) for _ in range(r.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = prose(60)
    base = prose(120).split()
    out = [None, "", "   \t \n", "one", "a b c d", "A B C D", "#*$ %& | <>", "x " * 400 + "y", "z" * 1500, prose(3000)]
    for k in range(14):                            # near copies of one text
        w = list(base)
        for _ in range(k % 7):
            w[r.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [" ".join(base).upper(), "  " + "\n".join(base) + "\n"]
    out += [prose(100) + " " + shared + "\n" + prose(50) for _ in range(5)]
    out += [prose(30) + "\nThe same line here.\n" + prose(20) + "\nThe same line here." for _ in range(30)]
    out += [prose(r.randint(5, 60)) for _ in range(20)] + ["tab\there  two\r\nlines　wide \U0001F600 <|endoftext|> it's 42"]
    out += [out[12]] * 6 + ["z" * 1500, shared]
    return out


@pytest.fixture(scope="session")
def documents(spark):
    """Small documents with nulls, ties, repeated rows, long texts and clashing columns."""
    from riskladder.llm.queries import ship

    ship(spark)
    rows = []
    for i, t in enumerate(_texts()):
        rows.append((i * 3 % 97 if i % 40 else i, t, ["en", "fr", None][i % 3], ["b", "a", None, "a"][i % 4], len(t or ""), 1, "x", 2, 3, 4))
    rows.append(rows[20])                          # a repeated row
    rows.append((None, rows[15][1], None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(documents):
    return documents.limit(0)
